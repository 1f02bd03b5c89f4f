"""Digest trees, key lists and segmented history."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakesync.operators import digests as D
from lakesync.operators import fold, history, quality
from lakesync.operators import uniqueness as U
from lakesync.sources.chunks import chunk_bounds
from tests.helpers import rows


def test_packed_lists_round_trip():
    rng = np.random.default_rng(2)
    for n in (0, 1, 5, 1000):
        values = np.unique(rng.integers(0, 1 << 40, n).astype(np.uint64))
        assert (U._unpacked(U._packed(values)) == values).all()
    edge = np.array([0, 1, 127, 128, 255, 1 << 20, (1 << 62) + 5], np.uint64)
    assert (U._unpacked(U._packed(edge)) == edge).all()
    dense = np.sort(rng.integers(0, 1 << U.BITS, 200_000).astype(np.uint64))
    assert len(U._packed(np.unique(dense))) < 3 * len(dense)


@pytest.mark.parametrize("held", [7, 1 << 20])
def test_suspected_violations_are_the_violations(spark, monkeypatch, held):
    monkeypatch.setattr(U, "HELD", held)
    table = spark.range(3000).select(
        F.when(F.col("id") % 500 == 0, 1).when(F.col("id") % 701 == 0, F.lit(None)).otherwise(F.col("id")).cast("bigint").alias("a"),
        F.when(F.col("id") % 900 == 0, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 2)).alias("b"),
    )
    for keys in (["a"], ["a", "b"], ["b"]):
        want = rows(fold.key_violations(table, keys), *keys, "rows")
        assert want and rows(U.suspected_violations(table, keys), *keys, "rows") == want
    # Few bits make false suspects, not false violations.
    monkeypatch.setattr(U, "BITS", 4)
    assert rows(U.suspected_violations(table, ["a"]), "a", "rows") == rows(fold.key_violations(table, ["a"]), "a", "rows")
    assert U.suspected_violations(table.where("false"), ["a"]).count() == 0


def test_lists_are_a_small_part_of_the_keys(spark):
    table = spark.range(0, 300_000, 1, 4).select(F.col("id").alias("a"), F.format_string("customer-%012d", "id").alias("b"))
    sizes = U.key_lists(table, ["a", "b"], 16).agg(F.sum(F.length("once") + F.length("twice")).alias("bytes")).first()["bytes"]
    assert sizes < 0.12 * 300_000 * (8 + 21)


def test_reconcile_reads_only_what_differs(spark, tmp_path):
    source = spark.range(20_000).select("id", (F.col("id") * 7).alias("v"))
    odd = F.col("id").isin(17, 11_111)
    target = source.where("id <> 4000").withColumn("v", F.when(odd, -1).otherwise(F.col("v")))
    paths = [str(tmp_path / n) for n in ("s", "t")]
    for table, path in zip((source, target), paths, strict=True):
        table.repartitionByRange(40, "id").sortWithinPartitions("id").write.parquet(path)
    source, target = (spark.read.parquet(p) for p in paths)
    bounds = chunk_bounds(source, ["id"], 100)
    trees = [D.digest_tree(t, ["id"], bounds) for t in (source, target)]
    assert trees[0].where("level = 0").count() == 100 and trees[0].where(f"level = {D.depth(bounds) - 1}").count() == 1
    assert sorted(r["node"] for r in D.differing_leaves(*trees, bounds).collect()) == [0, 20, 55]
    found = D.reconcile_tree(source, target, ["id"], bounds, *trees)
    assert rows(found, "id", "v", "side", "copies") == rows(quality.reconcile(source, target), "id", "v", "side", "copies")
    metrics = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in metrics and "GreaterThanOrEqual(id," in metrics
    same = D.reconcile_tree(source, source, ["id"], bounds, trees[0], trees[0])
    assert same.count() == 0


def test_many_differences_and_other_branch(spark, monkeypatch):
    monkeypatch.setattr(D, "CONDITIONS", 3)
    source = spark.range(2000).select("id", F.lit("x").alias("v"))
    target = source.withColumn("v", F.when(F.col("id") % 50 == 0, "y").otherwise(F.col("v")))
    bounds = chunk_bounds(source, ["id"], 40)
    trees = [D.digest_tree(t, ["id"], bounds) for t in (source, target)]
    found = D.reconcile_tree(source, target, ["id"], bounds, *trees)
    assert rows(found, "id", "v", "side", "copies") == rows(quality.reconcile(source, target), "id", "v", "side", "copies")


CHANGE = "id bigint, incremental boolean, file string, pos bigint, row_no int, ts_ms bigint"


def test_history_of_a_hot_key_in_one_file(spark):
    """A third of the feed is one key, all in a single log file; no window holds more than twice a segment."""
    n, parts = 6000, 12
    feed = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).cast("bigint").alias("id"),
        (F.col("id") >= 50).alias("incremental"), F.lit("bin.000001").alias("file"), F.col("id").alias("pos"), F.lit(0).alias("row_no"),
        (F.col("id") * 10).alias("ts_ms"),
    )
    out = history.change_history(feed, ["id"], segments=parts)
    got = {(r["id"], r["pos"]): (r["version"], r["valid_from"], r["valid_to"]) for r in out.collect()}
    per_key = {}
    for i in range(n):
        per_key.setdefault(7 if i % 3 == 0 else i % 500, []).append(i)
    want = {
        (k, p): (v, p * 10, places[v] * 10 if v < len(places) else None) for k, places in per_key.items() for v, p in enumerate(places, 1)
    }
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "from_json" not in plan and "hashpartitioning(id#" in plan and "_chunk" in plan
