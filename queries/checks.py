"""Checks of whole tables that move little of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync.operators import digests, uniqueness
from lakesync.sources.chunks import chunk_bounds
from queries import feed as E
from queries import state

LEAVES = 64


def key_violations_suspected(spark, sf_dir):
    """Keys that occur several times, found through compressed lists of their hashes."""
    rows = E.table(spark, sf_dir, "lineitem")
    return uniqueness.suspected_violations(rows, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "rows"
    )


def reconcile_digest_tree(spark, sf_dir):
    """Orders against a copy with a missing, a changed and a repeated order here and there, through digest trees."""
    source = E.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    key = F.col("o_orderkey")
    changed = source.where(key % 701 != 0).withColumn("o_orderstatus", F.when(key % 397 == 0, F.lit("X")).otherwise(F.col("o_orderstatus")))
    target = changed.unionByName(source.where(key % 997 == 0))
    keys = ["o_orderkey"]
    bounds = chunk_bounds(source, keys, LEAVES)
    trees = [digests.digest_tree(t, keys, bounds) for t in (source, target)]
    return digests.reconcile_tree(source, target, keys, bounds, *trees)


QUERIES = {"key_violations_suspected": key_violations_suspected, "reconcile_digest_tree": reconcile_digest_tree}

ORACLE = {
    "key_violations_suspected": state.ORACLE["key_violations"],
    "reconcile_digest_tree": """WITH s AS (SELECT o_orderkey, o_custkey, o_orderstatus FROM orders),
t AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 397 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM s WHERE o_orderkey % 701 <> 0
      UNION ALL SELECT * FROM s WHERE o_orderkey % 997 = 0),
d AS (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(sum(n) AS BIGINT) AS n
      FROM (SELECT *, 1 AS n FROM s UNION ALL SELECT *, -1 FROM t) GROUP BY ALL HAVING sum(n) <> 0)
SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN n > 0 THEN 'source_only' ELSE 'target_only' END AS side, abs(n) AS copies FROM d""",
}
