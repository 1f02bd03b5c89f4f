"""Target definitions, existence, write layout and the DDL log as a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards
from lakesync.operators import ddl, provision, routes as R
from lakesync.session import run_dir
from lakesync.sinks import tables
from lakesync.sources import catalog
from queries import feed as E
from queries.routing import NAMES_SQL, TARGET_SQL, _information_schema

# Two databases merge, one is re-sharded by a column that it lacks, one by a field without a shard function.
RULES = [
    R.DatabaseRule("i0", "db_0", pattern="db_[01]", target="merged", sync_type=R.ALL, shards=(R.ShardRule("all", "Brand#1.*"),)),
    R.DatabaseRule("i0", "db_2", sync_type=R.ALL, shards=(R.ShardRule("split", "Brand#2.*", count="TEN", shard_field=shards.UID_FIELD),)),
    R.DatabaseRule("i0", "db_3", sync_type=R.ALL, shards=(R.ShardRule("odd", "Brand#3.*", count="TEN", shard_field="c1"),)),
    R.DatabaseRule("i0", "db_4", sync_type=R.ALL),
]


def _meta_and_routes(spark, sf_dir):
    meta = catalog.column_meta(*_information_schema(spark, sf_dir))
    return meta, R.resolve_routes(catalog.tables(meta, "i0"), RULES)


def lake_schemas(spark, sf_dir):
    """Columns of all lake targets, in one plan."""
    return provision.lake_columns(*_meta_and_routes(spark, sf_dir)).select(
        "dst_db", "dst_table", "name", F.col("place").cast("bigint").alias("place"), "type", "nullable"
    )


def clone_schemas(spark, sf_dir):
    """Columns of all migration targets with the merge indexes."""
    return provision.clone_columns(*_meta_and_routes(spark, sf_dir)).select("dst_db", "dst_table", "name", "place", "type", "is_pk")


def clone_tables(spark, sf_dir):
    return provision.clone_targets(_meta_and_routes(spark, sf_dir)[1])


def shard_problems(spark, sf_dir):
    return provision.shard_problems(*_meta_and_routes(spark, sf_dir))


def missing_targets(spark, sf_dir):
    """Targets not there yet, when those of the brands ending in 1 are."""
    targets = provision.clone_targets(_meta_and_routes(spark, sf_dir)[1])
    return provision.missing_targets(targets, targets.where("dst_table like '%1'"))


def sorted_layout(spark, sf_dir):
    """Order lines written in key order into four files, more of a large table: the lines of an order lie in one file or at the edge of two."""
    path = run_dir(spark, "sorted")
    keys = ["l_orderkey", "l_linenumber"]
    tables.sorted_by_key(E.table(spark, sf_dir, "lineitem").select(*keys), keys, files=4).write.parquet(path)
    # A task writes one file; its number takes less memory in each group than the path.
    number = F.regexp_extract(F.input_file_name(), r"part-(\d+)-", 1).cast("int")
    read = spark.read.parquet(path).select(*keys, number.alias("file"))
    return read.groupBy("l_orderkey").agg(F.count("*").alias("rows"), (F.countDistinct("file") <= 2).alias("together"))


def returned_keys(spark, sf_dir):
    """Order keys that returned lines name."""
    return E.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey")).distinct()


def point_lookup(spark, sf_dir):
    """Orders of all keys that returned lines name, read from files with point-lookup filters on the key."""
    path = run_dir(spark, "lookup")
    orders = E.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    orders.write.options(**tables.bloom_options(["o_orderkey"])).parquet(path)
    return spark.read.parquet(path).join(returned_keys(spark, sf_dir), "o_orderkey", "left_semi")


def two_key_lookup(spark, sf_dir):
    """The same for a range of times, from files laid out by key and time together."""
    path = run_dir(spark, "interleaved")
    orders = E.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", E.micros("o_orderdate").alias(S.SYNC_TS))
    tables.interleaved(orders, ["o_orderkey", S.SYNC_TS], files=4).write.parquet(path)
    first, last = (E.micros(F.lit(d).cast("timestamp_ntz")) for d in ("1996-01-01 00:00:00", "1998-01-01 00:00:00"))
    some = spark.read.parquet(path).where((F.col(S.SYNC_TS) >= first) & (F.col(S.SYNC_TS) < last))
    return some.join(returned_keys(spark, sf_dir), "o_orderkey", "left_semi")


def target_folders(spark, sf_dir):
    """One write for all targets: rows by target folder."""
    path = run_dir(spark, "folders")
    rows = E.event_parts(E.table(spark, sf_dir, "events")).select(F.col("db").alias("dst_db"), F.col("tbl").alias("dst_table"), "event_id")
    tables.split_by_target(rows, path)
    return spark.read.parquet(path).groupBy("dst_db", "dst_table").agg(F.count("*").alias("rows"), F.max("event_id").alias("last"))


def ddl_stream_dedup(spark, sf_dir):
    """The DDL log as a stream: events that come twice count once."""
    root = run_dir(spark, "ddl")
    events = E.table(spark, sf_dir, "events")
    log = events.select(
        F.lit("i0").alias("instance"),
        F.lit("bin.000001").alias("file"),
        F.expr("event_id div 3").alias("pos"),
        F.lit("ALTER TABLE t ADD c INT").alias("ddl"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("at"),
    )
    log.repartition(3).write.parquet(f"{root}/in")
    stream = spark.readStream.schema(log.schema).option("maxFilesPerTrigger", "1").parquet(f"{root}/in")
    once = ddl.dedupe_stream(stream, "at", "1 hour")
    sink = once.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    sink.outputMode("append").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").select("instance", "file", "pos", "ddl")


QUERIES = {
    "lake_schemas": lake_schemas,
    "clone_schemas": clone_schemas,
    "clone_tables": clone_tables,
    "shard_problems": shard_problems,
    "missing_targets": missing_targets,
    "sorted_layout": sorted_layout,
    "point_lookup": point_lookup,
    "two_key_lookup": two_key_lookup,
    "target_folders": target_folders,
    "ddl_stream_dedup": ddl_stream_dedup,
}

META_SQL = f"""m AS (SELECT 'db_' || p_size % 5 AS db, p_brand AS tbl, 'c' || p_partkey AS name, p_partkey AS ordinal,
  p_partkey % 11 = 0 AND p_size % 5 < 3 AS is_pk, p_partkey % 7 = 0 AS auto,
  ({TARGET_SQL})[1 + p_partkey % len({NAMES_SQL})] AS type FROM part),
r AS (SELECT *, CASE WHEN db IN ('db_0', 'db_1') THEN 'merged' ELSE db END AS dst_db,
  CASE WHEN db IN ('db_0', 'db_1') AND tbl LIKE 'Brand#1%' THEN 'all' WHEN db = 'db_2' AND tbl LIKE 'Brand#2%' THEN 'split'
       WHEN db = 'db_3' AND tbl LIKE 'Brand#3%' THEN 'odd' ELSE tbl END AS dst_table,
  (db IN ('db_0', 'db_1') AND tbl LIKE 'Brand#1%') OR (db = 'db_2' AND tbl LIKE 'Brand#2%') OR (db = 'db_3' AND tbl LIKE 'Brand#3%') AS sharding,
  CASE WHEN (db = 'db_2' AND tbl LIKE 'Brand#2%') OR (db = 'db_3' AND tbl LIKE 'Brand#3%') THEN 10 ELSE 1 END AS shards FROM m),
c AS (SELECT DISTINCT ON (dst_db, dst_table, name) * FROM r ORDER BY dst_db, dst_table, name, db, tbl)"""
CLONES_SQL = """SELECT DISTINCT dst_db, dst_table || CASE WHEN shards > 1 THEN '_' || i ELSE '' END AS dst_table
FROM r, range(10) n(i) WHERE i < shards"""

ORACLE = {
    "lake_schemas": f"""WITH {META_SQL}
SELECT dst_db, dst_table, name, ordinal AS place, type, NOT is_pk AS nullable FROM c
UNION ALL SELECT DISTINCT dst_db, dst_table, 'f_ts', 1000000, 'bigint', TRUE FROM c
UNION ALL SELECT DISTINCT dst_db, dst_table, 'db_name', -2, 'string', FALSE FROM c WHERE sharding
UNION ALL SELECT DISTINCT dst_db, dst_table, 'table_name', -1, 'string', FALSE FROM c WHERE sharding""",
    "clone_schemas": f"""WITH {META_SQL}, g AS (SELECT dst_db, dst_table, min(ordinal) FILTER (WHERE auto) AS gen, bool_or(is_pk) AS keyed
  FROM c GROUP BY ALL HAVING bool_or(sharding) AND bool_or(auto))
SELECT dst_db, dst_table, name, CAST(ordinal AS DOUBLE) AS place, type, is_pk FROM c
UNION ALL SELECT dst_db, dst_table, 'db_index', gen + CAST(0.25 AS DOUBLE), 'string', keyed FROM g
UNION ALL SELECT dst_db, dst_table, 'table_index', gen + CAST(0.5 AS DOUBLE), 'string', keyed FROM g""",
    "clone_tables": f"WITH {META_SQL} {CLONES_SQL}",
    "shard_problems": f"""WITH {META_SQL} SELECT DISTINCT db, tbl AS table, 'Fuid' AS shard_field, 'no_shard_field' AS problem
FROM r WHERE shards > 1 AND db = 'db_2'
UNION ALL SELECT DISTINCT db, tbl, 'c1', 'no_shard_function' FROM r WHERE shards > 1 AND db = 'db_3'""",
    "missing_targets": f"WITH {META_SQL}, t AS ({CLONES_SQL}) SELECT * FROM t WHERE dst_table NOT LIKE '%1'",
    "sorted_layout": "SELECT l_orderkey, count(*) AS rows, TRUE AS together FROM lineitem GROUP BY ALL",
    "point_lookup": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "two_key_lookup": """SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) AS f_ts FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
  AND o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
    "target_folders": f"WITH {E.E_SQL} SELECT db AS dst_db, tbl AS dst_table, count(*) AS rows, max(event_id) AS last FROM e GROUP BY ALL",
    "ddl_stream_dedup": "SELECT DISTINCT 'i0' AS instance, 'bin.000001' AS file, event_id // 3 AS pos, 'ALTER TABLE t ADD c INT' AS ddl FROM events",
}
