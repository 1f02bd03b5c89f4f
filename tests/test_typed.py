"""Typed targets in buckets: plans, touched buckets, merges in any order."""

import os
import random
import re
import sys
import uuid

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lakesync import schemas as S  # noqa: E402
from lakesync.functions.types import ColumnSpec  # noqa: E402
from lakesync.operators import fold  # noqa: E402
from lakesync.sinks.typed import TypedTable  # noqa: E402

COLUMNS = [ColumnSpec("id", "BIGINT", is_pk=True), ColumnSpec("name", "VARCHAR"), ColumnSpec("n", "INT")]
CHANGE = "op int, id long, name string, n int, file string, pos long, ts_ms long, incremental boolean, row_no int, f_ts long"


def made(spark, tmp_path, profile=fold.LAKE, buckets=8):
    target = TypedTable(spark, f"typed_{uuid.uuid4().hex}", "t", COLUMNS, profile, buckets=buckets, location=str(tmp_path / "t"))
    target.create()
    return target


def states(spark, target, changes):
    rows = spark.createDataFrame([(op, i, f"v{pos}", pos, "bin.1", pos, 1, True, 0, pos) for op, i, pos in changes], CHANGE)
    rows = rows.select("id", F.struct("name", "n", "f_ts").alias("image"), "f_ts", *S.bookkeeping())
    return fold.fold(rows, ["id"], F.col("image"), F.col("f_ts"))


def plain(changes, profile):
    """id -> (name, n, f_ts) by running the changes in order."""
    out = {}
    for op, i, pos in sorted(changes, key=lambda c: c[2]):
        if op == S.DELETE:
            out.pop(i, None)
        elif op == S.INSERT or profile == fold.LAKE or i in out:
            out[i] = (f"v{pos}", pos, pos)
    return out


def held(target):
    return {r["id"]: (r["name"], r["n"], r["f_ts"]) for r in target.current().collect()}


@pytest.mark.parametrize("profile", [fold.LAKE, fold.MIGRATION])
def test_batches_in_any_order_and_repeated(spark, tmp_path, profile):
    pick = random.Random(3)
    target = made(spark, tmp_path, profile)
    changes = [(pick.choice([S.INSERT, S.UPDATE_AFTER, S.DELETE]), pick.randrange(40), pos) for pos in range(1, 301)]
    where = [pick.randrange(5) for _ in changes]
    batches = [[c for c, w in zip(changes, where, strict=True) if w == b] for b in range(5)]
    for b in (3, 0, 4, 3, 1, 2, 0):
        target.merge(states(spark, target, batches[b]))
    assert held(target) == plain(changes, profile)
    assert target.current().columns == ["id", "name", "n", "f_ts"]


def test_base_is_joined_where_it_lies(spark, tmp_path):
    target = made(spark, tmp_path)
    target.merge(states(spark, target, [(S.INSERT, i, i + 1) for i in range(200)]))
    net = states(spark, target, [(S.UPDATE_AFTER, 5, 900)])
    rows = target.merged(net, [0, 1])
    rows.collect()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    scan = next(line for line in final.splitlines() if "Bucketed: true" in line)
    assert "PartitionFilters: [_bucket" in scan
    # Between the scan of the base and the join above it nothing is exchanged or sorted.
    lines = final.splitlines()
    at = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    depth = lambda line: len(re.match(r"[\s:+\-*]*", line)[0])
    above, least = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < least:
            above.append(line)
            least = depth(line)
        if "Join" in line:
            break
    assert "Join" in above[-1] and not any("Exchange" in x or "Sort" in x for x in above)


def test_only_touched_buckets_are_written(spark, tmp_path):
    target = made(spark, tmp_path)
    target.merge(states(spark, target, [(S.INSERT, i, i + 1) for i in range(200)]))

    def files():
        return {p.parent.name: {f.name for f in p.parent.glob("*.parquet")} for p in (tmp_path / "t").rglob("*.parquet")}

    before = files()
    assert len(before) == 8 and all(len(f) == 1 for f in before.values())
    written = target.merge(states(spark, target, [(S.DELETE, 7, 500), (S.INSERT, 1007, 501)]))
    after = files()
    assert {k for k in after if after[k] != before.get(k)} == {f"_bucket={b}" for b in written} and 1 <= len(written) <= 2
    assert 7 not in held(target) and held(target)[1007] == ("v501", 501, 501)
    assert [r["id"] for r in target.deleted(since=499).collect()] == [7] and target.deleted(since=500).count() == 0


def test_increment_reaches_the_files(spark, tmp_path):
    target = made(spark, tmp_path)
    target.merge(states(spark, target, [(S.INSERT, i, i + 1) for i in range(50)]))
    some = target.current(since=45)
    assert sorted(r["id"] for r in some.collect()) == [45, 46, 47, 48, 49]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(f_ts,45)" in plan and "Aggregate" not in plan and "Exchange" not in plan


def test_again_over_its_files_and_rebuilt(spark, tmp_path):
    target = made(spark, tmp_path)
    changes = [(S.INSERT, i, i + 1) for i in range(30)] + [(S.DELETE, 3, 40)]
    net = states(spark, target, changes)
    target.merge(net)
    again = TypedTable(spark, f"typed_{uuid.uuid4().hex}", "t", COLUMNS, buckets=8, location=str(tmp_path / "t"))
    again.create()
    assert held(again) == plain(changes, fold.LAKE)
    other = made(spark, tmp_path / "other")
    other.rebuild(net)
    assert held(other) == held(target)
    assert other.merge(states(spark, other, [])) == []


@pytest.mark.parametrize("profile", [fold.LAKE, fold.MIGRATION])
@pytest.mark.parametrize("count", [1, 2, 7])
def test_differences_add_up_to_the_state(spark, tmp_path, profile, count):
    pick = random.Random(count)
    target = made(spark, tmp_path, profile, buckets=4)
    changes = [(pick.choice([S.INSERT, S.UPDATE_AFTER, S.DELETE]), pick.randrange(25), pos) for pos in range(1, 141)]
    where = [pick.randrange(count) for _ in changes]
    held_now = {}
    for b in range(count):
        net = states(spark, target, [c for c, w in zip(changes, where, strict=True) if w == b]).persist()
        for r in target.differences(net, target.touched(net)).collect():
            assert held_now.get(r["id"]) == (tuple(r["before"]) if r["before"] else None)
            assert r["before"] != r["after"]
            held_now[r["id"]] = tuple(r["after"]) if r["after"] else None
        target.merge(net)
        # What comes again changes nothing.
        assert target.differences(net).count() == 0
        net.unpersist()
    assert {k: v for k, v in held_now.items() if v} == plain(changes, profile) == held(target)


def test_large_net_changes_are_joined_by_sorting(spark, tmp_path):
    """What a bucket gets may be more than a task can hold: beyond a size the join must be one that spills."""
    target = made(spark, tmp_path)
    target.merge(states(spark, target, [(S.INSERT, i, i + 1) for i in range(100)]))
    net = states(spark, target, [(S.UPDATE_AFTER, i, 1000 + i) for i in range(0, 300, 3)])
    # A bucket of over 64 MB: texts of 10 MB, and no more keys than in the others.
    wide = net.withColumn("image", F.col("image").withField("name", F.repeat(F.col("image.name"), F.when(target.bucket() == 1, 2_000_000).otherwise(1))))
    for states_, large in ((net, False), (wide, True)):
        for rows in (target.merged(states_, range(8)), target.differences(states_, range(8))):
            plan = rows._jdf.queryExecution().executedPlan().toString()
            assert ("SortMergeJoin" in plan, "ShuffledHashJoin" in plan) == (large, not large)
            assert plan.count("Exchange hashpartitioning") <= 2 and "Bucketed: true" in plan  # of the net changes alone
    assert target.fits(target.sizes(net)) and not target.fits(target.sizes(wide))
    # Both joins give the same rows.
    assert {tuple(r) for r in target.merged(net, range(8), True).collect()} == {tuple(r) for r in target.merged(net, range(8), False).collect()}
    assert target.merge(net, target.sizes(net)) == list(range(8))
    assert held(target) == plain([(S.INSERT, i, i + 1) for i in range(100)] + [(S.UPDATE_AFTER, i, 1000 + i) for i in range(0, 300, 3)], fold.LAKE)
