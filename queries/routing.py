"""Catalog, rules, routes and the jobs over many targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards
from lakesync.functions.types import MYSQL_TO_SPARK, ColumnSpec, ddl_type
from lakesync.operators import decode, fold, quality, routes as R
from lakesync.operators.typed import typed_rows
from lakesync.plans import backfill as B, sync
from lakesync.session import bounded_broadcast, run_dir
from lakesync.sinks.store import StateStore
from lakesync.sources import catalog, envelopes, snapshot
from queries import feed as E


def routes_resolved(spark, sf_dir):
    """Routes of the shop under rules that rename, re-shard, list, exclude and leave out."""
    routes = R.with_shard_indexes(E.shop_routes(spark, sf_dir, E.MIXED_RULES))
    return routes.select(
        "src_db", "src_table", "dst_db", "dst_table", "sharding",
        F.col("shard_count").cast("bigint").alias("shard_count"),
        F.coalesce("shard_field", F.lit("")).alias("shard_field"),
        F.col("batch_size").cast("bigint").alias("batch_size"), "nodata",
        F.coalesce("db_index", F.lit("")).alias("db_index"),
        F.coalesce("table_index", F.lit("")).alias("table_index"),
    )


def databases_resolved(spark, sf_dir):
    """Source database to target database."""
    return R.resolve_databases(E.shop_catalog(spark, sf_dir), E.MIXED_RULES)


def routed_counts(spark, sf_dir):
    """Changes per target, data-carrying routes only."""
    routes = R.data_routes(E.shop_routes(spark, sf_dir, E.MIXED_RULES))
    routed = R.route(decode.decode(E.feed(spark, sf_dir)), routes)
    return quality.accepted(routed).groupBy("dst_db", "dst_table").agg(
        F.count(F.lit(1)).alias("changes"), F.countDistinct("db").alias("sources")
    )


def unrouted(spark, sf_dir):
    """Changes no rule takes, by source table and reason."""
    routes = R.data_routes(E.shop_routes(spark, sf_dir, E.MIXED_RULES))
    routed = R.route(decode.decode(E.feed(spark, sf_dir)), routes)
    return quality.quarantined(routed).groupBy("reason", "db", "table").agg(F.count(F.lit(1)).alias("changes"))


def route_collisions(spark, sf_dir):
    """Routing problems of a catalog with a doubled table and a second instance."""
    tables = E.shop_catalog(spark, sf_dir)
    doubled = tables.unionByName(tables.where("table = 't_event_4' and db = 'shop_00_db'")).unionByName(
        tables.where("table = 't_event_1'").withColumn("instance", F.lit("i1"))
    )
    flat = R.ShardRule("t_flat", "t_event_[23]", sharding=False)
    merged = R.ShardRule("t_event", "t_event_[0-9]")
    rules = [
        R.DatabaseRule(i, "shop", pattern="shop_[0-9]+_db", target="shop_db", shards=(flat, merged)) for i in ("i0", "i1")
    ]
    return R.route_collisions(R.resolve_routes(doubled, rules))


def merged_shards(spark, sf_dir):
    """All shards of a table in one scan, rows told apart by their source names."""
    rows = quality.accepted(
        sync.typed_changes(E.feed(spark, sf_dir), E.EVENT_COLUMNS, routes=E.shop_routes(spark, sf_dir), lineage=True)
    )
    return rows.groupBy(S.DB_NAME, S.TABLE_NAME).agg(
        F.count(F.lit(1)).alias("changes"), F.countDistinct("id").alias("keys"), F.max("value").alias("top")
    )


def lake_targets_current(spark, sf_dir):
    """Multi-table lake job: every target of the mixed rules in one aggregation."""
    routes = R.data_routes(E.keyed_routes(spark, sf_dir, E.MIXED_RULES))
    states = sync.states(sync.lake_targets(sync.routed_changes(E.feed(spark, sf_dir), routes)), 7)
    live = states.where(fold.action(fold.LAKE) == fold.UPSERT)
    return live.select(
        "dst_db", "dst_table", F.array_join("key", "/").alias("key"),
        F.try_variant_get("image.row", "$.value", "double").alias("value"), F.col("image.f_ts").alias("f_ts"),
    )


def migrated_targets(spark, sf_dir):
    """Multi-table migration job: re-sharded by user, keys widened by the merge indexes."""
    rules = [
        R.DatabaseRule(
            "i0", "shop_00_db", pattern="shop_([0-9][0-9])_db", target="shop_xx_db",
            shards=(R.ShardRule("t_event", "t_event_[0-9]", count="TEN", shard_field=shards.UID_FIELD),),
        )
    ]
    e = E.event_parts(E.table(spark, sf_dir, "events"))
    image = F.struct(
        F.col("image.id").alias("id"), F.col("image.user_id").alias(shards.UID_FIELD), F.col("image.value").alias("value")
    )
    deleted = F.col("op") == "d"
    docs = e.select(
        E.envelope(
            F.col("op"), F.when(deleted, image), F.when(~deleted, image),
            F.col("db"), F.col("tbl"), F.col("ts_ms"), F.col("file"), F.col("event_id"),
        ).alias("value")
    )
    routes = E.keyed_routes(spark, sf_dir, rules, autoincrement=True)
    targeted = sync.migration_targets(sync.routed_changes(docs, routes))
    live = sync.states(targeted, 7).where(fold.action(fold.MIGRATION) == fold.UPSERT)
    return live.select(
        "dst_db", "dst_table", F.array_join("key", "/").alias("key"),
        F.try_variant_get("image.row", "$.value", "double").alias("value"),
    )


def new_table_backfill(spark, sf_dir):
    """A rule change adds tables: their snapshot joins the running state."""
    old_rules = [
        R.DatabaseRule("i0", "shop_00_db", pattern="shop_([0-9][0-9])_db", target="shop_db",
                       shards=(R.ShardRule("t_event", "t_event_[0-4]"),))
    ]
    old, new = (E.keyed_routes(spark, sf_dir, r) for r in (old_rules, None))
    store = StateStore(spark, run_dir(spark, "backfill"))
    docs = E.feed(spark, sf_dir)
    store.write_batch(0, sync.states(sync.lake_targets(sync.routed_changes(docs, old)), 1))

    def snapshot_of(routes):
        # The snapshot of a new table holds its rows as of now: here the whole feed of it.
        keys = routes.withColumnsRenamed({"src_db": "db", "src_table": "table"}).select("instance", "db", "table")
        changes = decode.decode(docs).join(bounded_broadcast(keys), ["instance", "db", "table"], "left_semi")
        return R.route(changes, new, check_size=False)

    added = B.backfill(new, old, snapshot_of)
    key_of = sync.routed_key(F.col("keys"))
    targeted = sync.lake_targets(added.where("op <> 4").withColumn("key", key_of(F.col("row"))))
    store.write_batch(1, sync.states(targeted, 2))
    rows = store.current("shop_db", "t_event", E.EVENT_COLUMNS, fold.LAKE, lineage=True, sync_time=True)
    return E.event_result(rows, S.DB_NAME, S.TABLE_NAME, S.SYNC_TS)


def _information_schema(spark, sf_dir):
    """Catalog views derived from `part`: one source column per part."""
    part = E.table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    names = list(MYSQL_TO_SPARK) + ["JSON", "ENUM"]
    type_name = F.get(F.array(*[F.lit(n) for n in names]), (key % len(names)).cast("int"))
    at = [
        F.concat(F.lit("db_"), F.col("p_size") % 5).alias("table_schema"),
        F.col("p_brand").alias("table_name"),
        F.concat(F.lit("c"), key).alias("column_name"),
    ]
    columns = part.select(
        *at, key.alias("ordinal_position"), F.lower(type_name).alias("column_type"),
        F.lit(None).cast("string").alias("character_maximum_length"), F.col("p_name").alias("column_comment"),
        F.when(key % 7 == 0, F.lit("auto_increment")).otherwise(F.lit("")).alias("extra"),
    )
    statistics = part.where(key % 11 < 2).select(
        *at, F.lit(0).alias("non_unique"),
        F.when((key % 11 == 0) & (F.col("p_size") % 5 < 3), "PRIMARY").otherwise("u1").alias("index_name"),
    )
    return columns, statistics


def column_catalog(spark, sf_dir):
    """Column metadata of all tables in one scan, with the target type of each column."""
    meta = catalog.column_meta(*_information_schema(spark, sf_dir))
    return meta.select(
        "db", "table", "name", F.col("ordinal").cast("bigint").alias("ordinal"), "comment",
        "is_pk", "is_uk", "is_autoincrement", ddl_type("type_name").alias("target_type"),
    )


def table_keys(spark, sf_dir):
    """Key choice per table: primary key, else unique columns, else none."""
    meta = catalog.column_meta(*_information_schema(spark, sf_dir))
    tables = catalog.tables(meta, "i0")
    routes = tables.select(
        "instance", F.col("db").alias("src_db"), F.col("table").alias("src_table"), F.lit(True).alias("sharding")
    )
    keyed = catalog.with_keys(routes, meta)
    bad = catalog.keyless(keyed, lake=True).select("src_db", "src_table", F.lit(True).alias("no_lake_key"))
    return keyed.join(bad, ["src_db", "src_table"], "left").select(
        "src_db", "src_table", F.array_join("keys", ",").alias("keys"),
        F.coalesce("no_lake_key", F.lit(False)).alias("no_lake_key"), "merge_fields",
    )


def snapshot_typed(spark, sf_dir):
    """Direct snapshot of a typed table: dates, doubles and text through VARIANT rows."""
    orders = E.table(spark, sf_dir, "orders")
    columns = [
        ColumnSpec("o_orderkey", "BIGINT", is_pk=True),
        ColumnSpec("o_totalprice", "DOUBLE"),
        ColumnSpec("o_orderdate", "DATETIME"),
        ColumnSpec("o_orderpriority", "VARCHAR"),
    ]
    changes = snapshot.snapshot(orders, "i0", "shop", "orders", file="bin.000001", pos=0)
    rows = quality.accepted(typed_rows(changes, columns))
    return rows.select("o_orderkey", "o_totalprice", E.clock("o_orderdate").alias("o_orderdate"), "o_orderpriority")


def reconcile(spark, sf_dir):
    """Rows that differ between customers and a target with lost, changed and doubled rows."""
    source = E.table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    key = F.col("c_custkey")
    target = (
        source.where(key % 13 != 0)
        .withColumn("c_acctbal", F.when(key % 17 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    )
    target = target.unionByName(source.where(key % 19 == 0))
    return quality.reconcile(source, target)


def reconcile_nations(spark, sf_dir):
    """Groups whose count or checksum differs, the cheap first pass."""
    source = E.table(spark, sf_dir, "customer")
    target = source.where((F.col("c_nationkey") % 4 != 0) | (F.col("c_custkey") % 9 != 0))
    out = quality.reconcile_digests(source, target, ["c_nationkey"])
    return out.select(
        "c_nationkey", "source_rows", F.coalesce("target_rows", F.lit(0)).alias("target_rows")
    )


def landed_tables(spark, sf_dir):
    """Feed landed by source table; only the tables of the list rule are read."""
    path = run_dir(spark, "landed")
    envelopes.land(E.feed(spark, sf_dir), path)
    routes = E.shop_routes(spark, sf_dir, E.MIXED_RULES).where("src_db = 'shop_00_db'")
    wanted = routes.select(F.col("src_db").alias("db"), F.col("src_table").alias("table"))
    rows = decode.decode(envelopes.read_landed(spark, path, wanted))
    return rows.select("db", "table", "pos", F.col("op").cast("int").alias("op"))


QUERIES = {
    "landed_tables": landed_tables,
    "routes_resolved": routes_resolved,
    "databases_resolved": databases_resolved,
    "routed_counts": routed_counts,
    "unrouted": unrouted,
    "route_collisions": route_collisions,
    "merged_shards": merged_shards,
    "lake_targets_current": lake_targets_current,
    "migrated_targets": migrated_targets,
    "new_table_backfill": new_table_backfill,
    "column_catalog": column_catalog,
    "table_keys": table_keys,
    "snapshot_typed": snapshot_typed,
    "reconcile": reconcile,
    "reconcile_nations": reconcile_nations,
}

# Routing of the mixed rules, written out by hand.
MIXED_SQL = f"""{E.E_SQL},
t AS (SELECT DISTINCT db, tbl, CAST(regexp_extract(db, '0([0-9])', 1) AS INT) AS d,
      CAST(regexp_extract(tbl, '([0-9])$', 1) AS INT) AS n FROM e),
rt AS (SELECT db, tbl, d, n,
  CASE WHEN d IN (1, 2) THEN 'shop_mid' ELSE db END AS dst_db,
  CASE WHEN d IN (1, 2) AND n <= 3 THEN 't_low' WHEN d IN (1, 2) AND n = 5 THEN 't_five'
       WHEN d IN (1, 2) AND n = 7 THEN 't_seven' ELSE tbl END AS dst_table,
  d IN (1, 2) AND (n <= 3 OR n = 7) AS sharding, d IN (1, 2) AND n <= 3 AS low, d IN (1, 2) AND n = 7 AS nodata
  FROM t WHERE (d = 0 AND n IN (0, 4)) OR (d IN (1, 2) AND n <> 9))"""

NAMES_SQL = (
    "['DECIMAL','DECIMAL UNSIGNED','TINYINT','TINYINT UNSIGNED','BOOLEAN','SMALLINT','SMALLINT UNSIGNED','INT',"
    "'INT UNSIGNED','MEDIUMINT','MEDIUMINT UNSIGNED','FLOAT','FLOAT UNSIGNED','DOUBLE','DOUBLE UNSIGNED','TIMESTAMP',"
    "'DATETIME','BIGINT','BIGINT UNSIGNED','DATE','TIME','BIT','BINARY','BLOB','TINYBLOB','MEDIUMBLOB','LONGBLOB',"
    "'JSON','ENUM']"
)
TARGET_SQL = (
    "['decimal(38, 20)','decimal(38, 20)','int','int','boolean','int','int','int','int','int','int','float','float',"
    "'double','double','timestamp','timestamp','long','long','date','time','int','binary','binary','binary','binary',"
    "'binary','string','string']"
)

ORACLE = {
    "landed_tables": f"""WITH {E.E_SQL} SELECT db, tbl AS table, event_id AS pos, op FROM e
WHERE user_id % 4 = 0 AND user_id % 10 IN (0, 4)""",
    "routes_resolved": f"""WITH {MIXED_SQL}
SELECT db AS src_db, tbl AS src_table, dst_db, dst_table, sharding,
  CAST(CASE WHEN low THEN 10 ELSE 1 END AS BIGINT) AS shard_count,
  CASE WHEN low THEN 'Fuid' ELSE '' END AS shard_field, CAST(1024 AS BIGINT) AS batch_size, nodata,
  CASE WHEN sharding THEN '0' || d ELSE '' END AS db_index,
  CASE WHEN sharding THEN CAST(n AS VARCHAR) ELSE '' END AS table_index FROM rt""",
    "databases_resolved": f"""WITH {E.E_SQL} SELECT DISTINCT 'i0' AS instance, db AS src_db,
  CASE WHEN db IN ('shop_01_db', 'shop_02_db') THEN 'shop_mid' ELSE db END AS dst_db FROM e""",
    "routed_counts": f"""WITH {MIXED_SQL} SELECT dst_db, dst_table, count(*) AS changes, count(DISTINCT e.db) AS sources
FROM e JOIN rt ON e.db = rt.db AND e.tbl = rt.tbl WHERE NOT nodata GROUP BY ALL""",
    "unrouted": f"""WITH {MIXED_SQL} SELECT 'unrouted' AS reason, db, tbl AS table, count(*) AS changes FROM e
WHERE NOT EXISTS (SELECT 1 FROM rt WHERE rt.db = e.db AND rt.tbl = e.tbl AND NOT nodata) GROUP BY ALL""",
    "route_collisions": f"""WITH {E.E_SQL}, t AS (SELECT DISTINCT db, tbl FROM e),
c AS (SELECT 'i0' AS i, db, tbl FROM t UNION ALL
      SELECT 'i0', db, tbl FROM t WHERE db = 'shop_00_db' AND tbl = 't_event_4' UNION ALL
      SELECT 'i1', db, tbl FROM t WHERE tbl = 't_event_1'),
r AS (SELECT *, CASE WHEN tbl IN ('t_event_2', 't_event_3') THEN 't_flat' ELSE 't_event' END AS dst FROM c)
SELECT 'duplicate_source' AS problem, i || '.' || db || '.' || tbl AS subject, count(*) AS routes
FROM r GROUP BY ALL HAVING count(*) > 1
UNION ALL SELECT 'unsharded_merge', 'shop_db.t_flat', count(*) FROM r WHERE dst = 't_flat' HAVING count(*) > 1
UNION ALL SELECT 'several_instances', 'shop_db.' || dst, count(*) FROM r GROUP BY dst HAVING count(DISTINCT i) > 1""",
    "merged_shards": f"""WITH {E.E_SQL} SELECT db AS db_name, tbl AS table_name, count(*) AS changes,
  count(DISTINCT id) AS keys, max(value) AS top FROM e GROUP BY ALL""",
    "lake_targets_current": f"""WITH {MIXED_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY snap, event_id DESC) AS rn FROM e)
SELECT dst_db, dst_table, CASE WHEN sharding THEN r.db || '/' || r.tbl || '/' || id ELSE CAST(id AS VARCHAR) END AS key,
  value, CAST(7 AS BIGINT) AS f_ts
FROM r JOIN rt ON r.db = rt.db AND r.tbl = rt.tbl WHERE rn = 1 AND op <> 3 AND NOT nodata""",
    "migrated_targets": f"""WITH {E.migration_sql()}
SELECT 'shop_xx_db' AS dst_db, 't_event_' || user_id % 10 AS dst_table,
  id || '/0' || user_id % 4 || '/' || user_id % 10 AS key, value FROM cur""",
    "new_table_backfill": f"""WITH {E.lake_sql()}
SELECT db AS db_name, tbl AS table_name, CASE WHEN user_id % 10 <= 4 THEN 1 ELSE 2 END::BIGINT AS f_ts,
  id, user_id, value, event_type, {E.TS_SQL} FROM cur""",
    "column_catalog": f"""SELECT 'db_' || p_size % 5 AS db, p_brand AS table, 'c' || p_partkey AS name,
  p_partkey AS ordinal, p_name AS comment, p_partkey % 11 = 0 AND p_size % 5 < 3 AS is_pk,
  p_partkey % 11 < 2 AS is_uk, p_partkey % 7 = 0 AS is_autoincrement,
  ({TARGET_SQL})[1 + p_partkey % len({NAMES_SQL})] AS target_type FROM part""",
    "table_keys": """WITH c AS (SELECT 'db_' || p_size % 5 AS src_db, p_brand AS src_table, p_partkey AS k,
  p_partkey % 11 = 0 AND p_size % 5 < 3 AS pk, p_partkey % 11 < 2 AS uk FROM part),
g AS (SELECT src_db, src_table, count(*) FILTER (WHERE pk) AS npk,
  string_agg('c' || k, ',' ORDER BY k) FILTER (WHERE pk) AS pks,
  string_agg('c' || k, ',' ORDER BY k) FILTER (WHERE uk) AS uks, bool_or(k % 7 = 0) AS merge_fields
  FROM c GROUP BY ALL)
SELECT src_db, src_table, coalesce(CASE WHEN npk > 0 THEN pks ELSE uks END, '') AS keys, npk = 0 AS no_lake_key,
  merge_fields FROM g""",
    "snapshot_typed": """SELECT o_orderkey, o_totalprice,
  strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate, o_orderpriority FROM orders""",
    "reconcile": """WITH s AS (SELECT c_custkey, c_name, c_acctbal FROM customer),
t AS (SELECT c_custkey, c_name, CASE WHEN c_custkey % 17 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal
      FROM s WHERE c_custkey % 13 <> 0 UNION ALL SELECT * FROM s WHERE c_custkey % 19 = 0)
SELECT *, 'source_only' AS side, count(*) AS copies FROM (SELECT * FROM s EXCEPT ALL SELECT * FROM t) GROUP BY ALL
UNION ALL SELECT *, 'target_only', count(*) FROM (SELECT * FROM t EXCEPT ALL SELECT * FROM s) GROUP BY ALL""",
    "reconcile_nations": """SELECT c_nationkey, count(*) AS source_rows,
  count(*) FILTER (WHERE c_nationkey % 4 <> 0 OR c_custkey % 9 <> 0) AS target_rows
FROM customer GROUP BY ALL HAVING source_rows <> target_rows""",
}
