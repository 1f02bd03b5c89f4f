"""Digest trees: two copies of a keyed table compared without reading the rows they share.

The key range is cut into leaves; a node is FANOUT nodes of the level below it. Row counts and
checksums add up, so one pass over a table gives the digests of all levels, to be stored next to
it. Two trees are compared from the top: only children of nodes that differ are looked at, and only
the rows of differing leaves are read, by a condition on the key that reaches the files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.operators.quality import reconcile, table_digest
from lakesync.sources.chunks import chunk_of, predicates

FANOUT = 16
# Differing leaves that become conditions of a scan; more are found by the number of their leaf.
CONDITIONS = 200


def _types(table: DataFrame, keys: Sequence[str]) -> list[str]:
    types = dict(table.dtypes)
    return [types[k] for k in keys]


def digest_tree(table: DataFrame, keys: Sequence[str], bounds: Sequence[tuple]) -> DataFrame:
    """(level, node, rows, checksum) of all levels, the leaves (see chunks.chunk_bounds) being level 0."""
    leaf = chunk_of([F.col(k) for k in keys], bounds, _types(table, keys)).cast("bigint")
    # The digest is over the columns of the table, the leaf apart.
    leaves = table_digest(table.select(F.struct(*table.columns).alias("_row"), leaf.alias("_leaf")), ["_leaf"])
    levels = [F.struct(F.lit(n).alias("level"), F.expr(f"_leaf div {FANOUT**n}").alias("node")) for n in range(depth(bounds))]
    spread = leaves.select(F.explode(F.array(*levels)).alias("at"), "rows", "checksum")
    return spread.groupBy("at.level", "at.node").agg(F.sum("rows").alias("rows"), F.sum("checksum").alias("checksum"))


def depth(bounds: Sequence[tuple]) -> int:
    """Levels of a tree, up to the one node that holds all."""
    n, levels = len(bounds) + 1, 1
    while n > 1:
        n, levels = -(-n // FANOUT), levels + 1
    return levels


def differing_leaves(source: DataFrame, target: DataFrame, bounds: Sequence[tuple]) -> DataFrame:
    """(node): leaves whose digests differ, found from the top of two stored trees."""
    differ = None
    for level in reversed(range(depth(bounds))):
        sides = []
        for name, tree in (("source", source), ("target", target)):
            here = tree.where(F.col("level") == level)
            if differ is not None:
                here = here.join(differ, F.expr(f"node div {FANOUT}") == F.col("up"), "left_semi")
            sides.append(here.select("node", F.struct("rows", "checksum").alias(name)))
        same = F.col("source").eqNullSafe(F.col("target"))
        found = sides[0].join(sides[1], "node", "full").where(~same).select("node")
        differ = found.select(F.col("node").alias("up"))
    return found


def reconcile_tree(
    source: DataFrame, target: DataFrame, keys: Sequence[str], bounds: Sequence[tuple], source_tree: DataFrame, target_tree: DataFrame
) -> DataFrame:
    """What quality.reconcile gives, reading only rows of leaves that differ."""
    leaves = differing_leaves(source_tree, target_tree, bounds)
    some = [r["node"] for r in leaves.limit(CONDITIONS + 1).collect()]
    if len(some) <= CONDITIONS:
        conditions = predicates(keys, bounds)
        wanted = " OR ".join(f"({conditions[n]})" for n in sorted(some)) or "false"
        return reconcile(source.where(wanted), target.where(wanted))

    def within(table: DataFrame) -> DataFrame:
        leaf = chunk_of([F.col(k) for k in keys], bounds, _types(table, keys)).cast("bigint")
        return table.withColumn("_leaf", leaf).join(leaves.withColumnRenamed("node", "_leaf"), "_leaf", "left_semi").drop("_leaf")

    return reconcile(within(source), within(target))
