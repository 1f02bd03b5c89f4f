"""Change feeds derived from the test tables, and their SQL twins.

Feed E turns every row of `events` into one change of a sharded shop: snapshot rows
before 2024-01-04, then inserts, deletes and updates. The Spark side always goes
through JSON envelopes and the operators; the SQL side reads `events` directly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.functions import types as T
from lakesync.functions.types import ColumnSpec
from lakesync.operators.routes import ALL, EXCLUDE, INCLUDE, DatabaseRule, ShardRule, resolve_routes
from lakesync.session import checkpointed, configure, spread, stored
from lakesync.sources import catalog

# Columns of the shop tables.
EVENT_COLUMNS = [
    ColumnSpec("id", "BIGINT", is_pk=True),
    ColumnSpec("user_id", "BIGINT"),
    ColumnSpec("value", "DOUBLE"),
    ColumnSpec("event_type", "VARCHAR"),
    ColumnSpec("ts", "DATETIME", wire=T.MICRO_TIMESTAMP),
]

SHOP_RULES = [
    DatabaseRule(
        "i0",
        "shop_00_db",
        pattern="shop_([0-9][0-9])_db",
        target="shop_db",
        sync_type=INCLUDE,
        shards=(ShardRule("t_event", "t_event_[0-9]"),),
    )
]

# Rules that leave tables out, rename, list and exclude; for the routing queries.
MIXED_RULES = [
    DatabaseRule("i0", "shop_00_db", sync_type=INCLUDE, tables=["t_event_0", "t_event_4"]),
    DatabaseRule(
        "i0", "shop_01_db", pattern="shop_0[12]_db", target="shop_mid", sync_type=EXCLUDE,
        tables=["t_event_9"],
        shards=(
            ShardRule("t_low", "t_event_[0-3]", count="TEN"),
            ShardRule("t_five", "t_event_5", sharding=False),
            ShardRule("t_seven", "t_event_7", nodata=True),
        ),
    ),
    DatabaseRule("i0", "shop_02_db", target="never_used", sync_type=ALL),
    DatabaseRule("i0", "shop_03_db", sync_type=INCLUDE),
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(ts: Column | str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp") if isinstance(ts, str) else ts.cast("timestamp"))


def event_parts(events: DataFrame) -> DataFrame:
    """Feed E as columns: row fields, op letter, source names and position."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("bigint")
    snap = F.col("ts") < F.lit("2024-01-04 00:00:00").cast("timestamp_ntz")
    letter = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    return events.select(
        "event_id",
        k.alias("k"),
        F.when(snap, F.lit("r")).otherwise(letter).alias("op"),
        F.concat(F.lit("shop_0"), F.col("user_id") % 4, F.lit("_db")).alias("db"),
        F.concat(F.lit("t_event_"), F.col("user_id") % 10).alias("tbl"),
        F.when(snap, F.lit(0)).otherwise(F.floor(micros("ts") / 1000)).cast("bigint").alias("ts_ms"),
        F.concat(
            F.lit("bin."), F.lpad(F.floor(F.col("event_id") / 1000).cast("string"), 6, "0")
        ).alias("file"),
        F.struct(
            (F.col("user_id") * 100 + k).alias("id"),
            "user_id",
            "value",
            "event_type",
            micros("ts").alias("ts"),
        ).alias("image"),
    )


def envelope(
    op: Column, before: Column, after: Column, db: Column, tbl: Column, ts_ms: Column, file: Column, pos: Column,
    instance: Column | None = None,
) -> Column:
    """One envelope as JSON text."""
    return F.to_json(
        F.struct(
            (instance if instance is not None else F.lit("i0")).alias("instance"),
            op.alias("op"),
            before.alias("before"),
            after.alias("after"),
            F.struct(
                db.alias("db"), tbl.alias("table"), ts_ms.alias("ts_ms"), file.alias("file"), pos.alias("pos"),
                F.lit(0).alias("row"),
            ).alias("source"),
        )
    )


def event_envelopes(events: DataFrame) -> DataFrame:
    """Feed E as envelope text; works on a stream as well."""
    e = event_parts(events)
    deleted = F.col("op") == "d"
    return e.select(
        envelope(
            F.col("op"),
            F.when(deleted, F.col("image")),
            F.when(~deleted, F.col("image")),
            F.col("db"), F.col("tbl"), F.col("ts_ms"), F.col("file"), F.col("event_id"),
        ).alias("value")
    )


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_envelopes(spread(table(spark, sf_dir, "events")))


def row_envelopes(rows: DataFrame, db: str, tbl: str, image: Column, pos: Column, ts_ms: int = 1) -> DataFrame:
    """Rows of any table as insert envelopes of one source table."""
    none = F.lit(None).cast("string")
    return rows.select(
        envelope(
            F.lit("c"), none, image, F.lit(db), F.lit(tbl), F.lit(ts_ms).cast("bigint"), F.lit("bin.000001"), pos
        ).alias("value")
    )


def shop_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source tables of the shop."""
    e = event_parts(table(spark, sf_dir, "events"))
    return e.select(F.lit("i0").alias("instance"), "db", F.col("tbl").alias("table")).distinct()


def shop_routes(spark: SparkSession, sf_dir: str, rules=None) -> DataFrame:
    """Resolved routes, written once: metadata must not recompute its catalog scan per use."""
    routes = resolve_routes(shop_catalog(spark, sf_dir), rules or SHOP_RULES)
    return checkpointed(routes)


def shop_meta(tables: DataFrame, autoincrement: bool = False) -> DataFrame:
    """COLUMN_META of the shop tables."""
    columns = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("name"), F.lit(c.type_name).alias("type_name"), F.lit(i).alias("ordinal"),
                F.lit(c.is_pk).alias("is_pk"),
            )
            for i, c in enumerate(EVENT_COLUMNS)
        ]
    )
    return tables.select("db", "table", F.inline(columns)).select(
        "db", "table", "name", "type_name", "ordinal",
        F.lit(None).cast("int").alias("length"), F.lit(None).cast("string").alias("comment"),
        "is_pk", F.lit(False).alias("is_uk"),
        (F.col("is_pk") & F.lit(autoincrement)).alias("is_autoincrement"),
    )


def keyed_routes(spark: SparkSession, sf_dir: str, rules=None, autoincrement: bool = False) -> DataFrame:
    """Routes with key columns, as the multi-table job needs them; the catalog is scanned once for both."""
    tables = stored(shop_catalog(spark, sf_dir), "catalog")
    routes = resolve_routes(tables, rules or SHOP_RULES)
    return checkpointed(catalog.with_keys(routes, shop_meta(tables.drop("instance"), autoincrement)))


def clock(ts: Column | str) -> Column:
    """Timestamp as text with microseconds, the form used in query results."""
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def event_result(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(*extra, "id", "user_id", "value", "event_type", clock("ts").alias("ts"))


# The same feed for the oracle.
E_SQL = """e AS (
  SELECT event_id, user_id, value, event_type, ts,
    CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k,
    user_id * 100 + CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS id,
    'shop_0' || (user_id % 4) || '_db' AS db,
    't_event_' || (user_id % 10) AS tbl,
    ts < TIMESTAMP '2024-01-04' AS snap,
    CASE WHEN ts < TIMESTAMP '2024-01-04' OR event_type = 'signup' THEN 0
         WHEN event_type = 'error' THEN 3 ELSE 2 END AS op,
    CASE WHEN ts < TIMESTAMP '2024-01-04' THEN 0 ELSE epoch_us(ts) // 1000 END AS ts_ms,
    'bin.' || lpad(CAST(event_id // 1000 AS VARCHAR), 6, '0') AS file
  FROM events)"""

TS_SQL = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts"

def lake_sql(where: str = "TRUE") -> str:
    """Common table expressions giving `cur`, the lake state of feed E restricted by `where`."""
    return f"""{E_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY snap, event_id DESC) AS rn FROM e WHERE {where}),
cur AS (SELECT * FROM r WHERE rn = 1 AND op <> 3)"""


def migration_sql(where: str = "TRUE") -> str:
    """Common table expressions giving `cur`, the migration state of feed E."""
    return f"""{E_SQL},
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY NOT snap, event_id) AS n FROM e WHERE {where}),
a AS (SELECT id, max(n) AS an FROM f WHERE op IN (0, 3) GROUP BY id),
live AS (SELECT f.id FROM f JOIN a ON f.id = a.id AND f.n = a.an AND f.op = 0),
img AS (SELECT f.*, row_number() OVER (PARTITION BY f.id ORDER BY n DESC) AS rn
        FROM f JOIN live ON f.id = live.id WHERE f.op IN (0, 2)),
cur AS (SELECT * FROM img WHERE rn = 1)"""
