"""Cases in which changes used to be lost: unique keys, moved shards, new logs, deletes downstream, NULLs."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards
from lakesync.functions.types import ColumnSpec
from lakesync.operators import ddl, fold, quality, routes as R
from lakesync.plans import layers, sync
from lakesync.session import run_dir
from lakesync.sinks.store import StateStore
from queries import feed as E
from queries.schema_changes import CUSTOMER_COLUMNS, _customer_ddl
from queries.state import RESULT

UNIQUE_COLUMNS = [ColumnSpec("id", "BIGINT", is_uk=True), ColumnSpec("user_id", "BIGINT"), ColumnSpec("value", "DOUBLE")]


def unique_key_current(spark, sf_dir):
    """A table with a unique key only: NULL keys are set aside, key changes move the row."""
    e = E.event_parts(E.table(spark, sf_dir, "events"))
    update = F.col("op") == "u"
    image = F.col("image")
    key = F.when(F.col("event_id") % 11 != 0, image["id"] * 2)
    base = image.withField("id", key)
    old = F.when(update & (F.col("event_id") % 5 == 0), image.withField("id", key + 1)).otherwise(base)
    first = F.when(F.col("event_id") % 2 == 0, base).otherwise(image.withField("id", key + 1))
    docs = e.select(
        E.envelope(
            F.when(update, F.lit("u")).otherwise(F.lit("c")), F.when(update, old), F.when(update, base).otherwise(first),
            F.col("db"), F.col("tbl"), F.lit(1).cast("bigint"), F.col("file"), F.col("event_id"),
        ).alias("value")
    )
    return sync.current_rows(docs, UNIQUE_COLUMNS, fold.MIGRATION).select("id", "user_id", "value")


def shard_move_current(spark, sf_dir):
    """Updates that move a row to another shard of its target."""
    rules = [
        R.DatabaseRule(
            "i0", "shop_00_db", pattern="shop_([0-9][0-9])_db", target="shop_db",
            shards=(R.ShardRule("t_event", "t_event_[0-9]", count="TEN", shard_field=shards.UID_FIELD),),
        )
    ]
    e = E.event_parts(E.table(spark, sf_dir, "events"))
    deleted, moved = F.col("op") == "d", (F.col("op") == "u") & (F.col("event_id") % 3 == 0)

    def image(uid):
        return F.struct(F.col("image.id").alias("id"), uid.alias(shards.UID_FIELD), F.col("image.value").alias("value"))

    now = image(F.col("image.user_id"))
    docs = e.select(
        E.envelope(
            F.col("op"), F.when(deleted, now).when(moved, image(F.col("image.user_id") + 1)), F.when(~deleted, now),
            F.col("db"), F.col("tbl"), F.col("ts_ms"), F.col("file"), F.col("event_id"),
        ).alias("value")
    )
    targeted = sync.migration_targets(sync.routed_changes(docs, E.keyed_routes(spark, sf_dir, rules)))
    live = sync.states(targeted, 7).where(fold.action(fold.MIGRATION) == fold.UPSERT)
    return live.select(
        "dst_table", F.get("key", F.lit(0)).cast("bigint").alias("id"), F.try_variant_get("image.row", "$.value", "double").alias("value")
    )


def log_restart_current(spark, sf_dir):
    """A failover in the middle of the feed: the new log counts from 0 again, and a third one is unknown."""
    e = E.event_parts(E.table(spark, sf_dir, "events"))
    name = (
        F.when(F.col("event_id") % 97 == 0, F.lit("alien-bin."))
        .when(F.col("event_id") >= 500, F.lit("newhost-bin."))
        .otherwise(F.lit("bin."))
    )
    number = F.when(F.col("event_id") >= 500, F.expr("event_id div 1000")).otherwise(F.lit(900))
    deleted = F.col("op") == "d"
    docs = e.select(
        E.envelope(
            F.col("op"), F.when(deleted, F.col("image")), F.when(~deleted, F.col("image")), F.col("db"), F.col("tbl"), F.col("ts_ms"),
            F.concat(name, F.lpad(number.cast("string"), 6, "0")), F.col("event_id"),
        ).alias("value")
    )
    logs = spark.createDataFrame([("i0", "bin.", 0), ("i0", "newhost-bin.", 1)], "instance string, base string, generation int")
    return E.event_result(sync.current_rows(docs, E.EVENT_COLUMNS, fold.LAKE, logs=logs))


def dwd_deletes(spark, sf_dir):
    """A downstream table after two increments: rows deleted for good go there too."""
    store, routes = StateStore(spark, run_dir(spark, "dwd")), E.keyed_routes(spark, sf_dir)
    routed = sync.targets(sync.routed_changes(E.feed(spark, sf_dir), routes), fold.LAKE)
    early = ~F.col("incremental") | (F.col("pos") < 500)
    keys = [S.DB_NAME, S.TABLE_NAME, "id"]

    def ods():
        rows = store.current("shop_db", "t_event", E.EVENT_COLUMNS, fold.LAKE, lineage=True, sync_time=True)
        return rows.withColumn(S.IS_DEL, F.lit(0))

    store.write_batch(0, sync.states(routed.where(early), 1))
    dwd = ods().drop(S.IS_DEL)
    store.write_batch(1, sync.states(routed.where(~early), 2))
    gone = store.deleted_keys("shop_db", "t_event", E.EVENT_COLUMNS, fold.LAKE, 1, lineage=True)
    return E.event_result(layers.clean_apply(dwd, ods(), keys, since=1, gone=gone))


def reconcile_nulls(spark, sf_dir):
    """Nations whose customers have a value in the other of two columns."""
    key = F.col("c_custkey")
    rows = E.table(spark, sf_dir, "customer").select("c_nationkey", "c_name", key)
    none = F.lit(None).cast("string")

    def pair(first):
        return rows.select("c_nationkey", F.when(first, F.col("c_name")).otherwise(none).alias("a"), F.when(first, none).otherwise(F.col("c_name")).alias("b"))

    swapped = (key % 7 == 0) & (F.col("c_nationkey") % 2 == 0)
    return quality.reconcile_digests(pair(F.lit(True)), pair(~swapped), ["c_nationkey"]).select("c_nationkey", "source_rows", "target_rows")


def ddl_status(spark, sf_dir):
    """What became of each DDL event: only those whose action changed the schema are applied."""
    log = _customer_ddl(spark, sf_dir)
    nation = E.table(spark, sf_dir, "nation").select(
        F.lit("i0").alias("instance"), F.lit("shop").alias("dst_db"), F.lit("customer").alias("dst_table"),
        F.when(F.col("n_nationkey") % 2 == 0, "CREATE INDEX i ON customer (c_name)").otherwise("ALTER TABLE customer DROP COLUMN absent").alias("ddl"),
        F.lit("bin.000002").alias("file"), F.col("n_nationkey").cast("bigint").alias("pos"), F.lit(9).cast("bigint").alias("ts_ms"),
    )
    both = log.unionByName(nation)
    return ddl.evolution_status(both, ddl.evolve_from_log(CUSTOMER_COLUMNS, both, "shop", "customer")).select("file", "pos", "status")


QUERIES = {
    "unique_key_current": unique_key_current,
    "shard_move_current": shard_move_current,
    "log_restart_current": log_restart_current,
    "dwd_deletes": dwd_deletes,
    "reconcile_nulls": reconcile_nulls,
    "ddl_status": ddl_status,
}

ORACLE = {
    "unique_key_current": f"""WITH {E.E_SQL},
u AS (SELECT *, NOT snap AND event_type NOT IN ('signup', 'error') AS upd FROM e WHERE event_id % 11 <> 0),
c AS (SELECT event_id, user_id, value, CASE WHEN upd AND event_id % 5 <> 0 THEN 2 ELSE 0 END AS op,
             CASE WHEN upd OR event_id % 2 = 0 THEN id * 2 ELSE id * 2 + 1 END AS id FROM u
      UNION ALL SELECT event_id, user_id, value, 3, id * 2 + 1 FROM u WHERE upd AND event_id % 5 = 0),
a AS (SELECT id, arg_max(op, event_id) AS aop FROM c WHERE op IN (0, 3) GROUP BY id),
i AS (SELECT id, arg_max(user_id, event_id) AS user_id, arg_max(value, event_id) AS value FROM c WHERE op IN (0, 2) GROUP BY id)
SELECT i.* FROM i JOIN a ON a.id = i.id WHERE aop = 0""",
    "shard_move_current": f"""WITH {E.E_SQL},
c AS (SELECT id, user_id % 10 AS shard, value, CASE WHEN op = 2 AND event_id % 3 = 0 THEN 0 ELSE op END AS op, snap, event_id FROM e
      UNION ALL SELECT id, (user_id + 1) % 10, value, 3, snap, event_id FROM e WHERE op = 2 AND event_id % 3 = 0),
n AS (SELECT *, row_number() OVER (PARTITION BY id, shard ORDER BY NOT snap, event_id) AS n FROM c),
a AS (SELECT id, shard, arg_max(op, n) AS aop FROM n WHERE op IN (0, 3) GROUP BY ALL),
i AS (SELECT id, shard, arg_max(value, n) AS value FROM n WHERE op IN (0, 2) GROUP BY ALL)
SELECT 't_event_' || i.shard AS dst_table, i.id, i.value FROM i JOIN a ON a.id = i.id AND a.shard = i.shard WHERE aop = 0""",
    "log_restart_current": f"WITH {E.lake_sql('event_id % 97 <> 0')} SELECT {RESULT} FROM cur",
    "dwd_deletes": f"WITH {E.lake_sql()} SELECT {RESULT} FROM cur",
    "reconcile_nulls": """SELECT c_nationkey, count(*) AS source_rows, count(*) AS target_rows FROM customer
WHERE c_nationkey % 2 = 0 GROUP BY ALL HAVING count(*) FILTER (WHERE c_custkey % 7 = 0) > 0""",
    "ddl_status": """SELECT 'bin.000001' AS file, r_regionkey * 100 + 100 AS pos, 'applied' AS status FROM region
UNION ALL SELECT 'bin.000002', n_nationkey, 'unchanged' FROM nation""",
}
