"""Chunked full reads: balance, coverage, and the log laid over chunks."""

import random

import pytest
from pyspark.sql import functions as F

from lakesync.sources import chunks as C


def sizes(table, keys, bounds):
    types = [dict(table.dtypes)[k] for k in keys]
    counted = table.groupBy(C.chunk_of([F.col(k) for k in keys], bounds, types).alias("chunk")).count().collect()
    return {r["chunk"]: r["count"] for r in counted}


@pytest.mark.parametrize("n", [1, 2, 7, 50])
def test_skewed_key_gives_even_chunks(spark, n):
    table = spark.range(20_000).select(F.expr("cast(exp(id / 1500.0) * 1000 as bigint) * 100000 + id as id"))
    bounds = C.chunk_bounds(table, ["id"], n)
    counted = sizes(table, ["id"], bounds)
    assert len(bounds) == n - 1 and bounds == sorted(bounds)
    assert sum(counted.values()) == 20_000 and max(counted.values()) <= 2 * 20_000 / n


def test_hot_values_are_cut_by_the_next_columns(spark):
    a = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, 8).otherwise(F.col("id")).cast("bigint")
    b = F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 1000).cast("int")
    table = spark.range(30_000).select(a.alias("a"), b.alias("b"), F.col("id").alias("c"))
    bounds = C.chunk_bounds(table, ["a", "b", "c"], 24)
    counted = sizes(table, ["a", "b", "c"], bounds)
    assert sum(counted.values()) == 30_000 and max(counted.values()) <= 2 * 30_000 / len(counted)
    # Conditions as SQL cut alike, with no row twice and none left out.
    by_sql = [table.where(p).count() for p in C.predicates(["a", "b", "c"], bounds)]
    assert by_sql == [counted.get(i, 0) for i in range(len(bounds) + 1)]


def test_small_and_equal_tables(spark):
    assert C.chunk_bounds(spark.range(0), ["id"], 5) == []
    one = spark.range(10).select(F.lit(3).alias("id"))
    bounds = C.chunk_bounds(one, ["id"], 4)
    assert sum(sizes(one, ["id"], bounds).values()) == 10
    assert C.predicates(["id"], []) == ["1 = 1"]
    days = spark.range(1000).select(F.expr("date_add(date'2024-01-01', cast(id as int))").alias("d"))
    bounds = C.chunk_bounds(days, ["d"], 4)
    assert [days.where(p).count() for p in C.predicates(["d"], bounds)] == [sizes(days, ["d"], bounds)[i] for i in range(4)]


def test_reading_between_positions(spark):
    """Each wave of chunks sees its own state of the table; the feed gives the last one."""
    pick = random.Random(6)
    state, log, end = {k: 0 for k in range(0, 300, 3)}, [], 0

    def change(times):
        nonlocal end
        for _ in range(times):
            end += 1
            k, op = pick.randrange(300), pick.choice("cud")
            if op == "d":
                state.pop(k, None)
            else:
                state[k] = end
            log.append((k, op, end))

    change(50)
    start = spark.createDataFrame(list(state.items()), "k int, v int")
    bounds = C.chunk_bounds(start, ["k"], 6)

    def read(conditions):
        change(20)
        seen = spark.createDataFrame(list(state.items()), "k int, v int").where(" OR ".join(f"({c})" for c in conditions))
        change(20)
        return seen

    rows, marks = C.read_chunks(spark, read, C.predicates(["k"], bounds), lambda: ("bin.1", end), 2)
    change(60)
    changes = spark.createDataFrame([(k, op, "bin.1", pos) for k, op, pos in log], "k int, op string, file string, pos bigint")
    near = C.marked(changes, C.chunk_of([F.col("k")], bounds, ["int"]), marks)
    assert near.where("not _after").count() > 0 and near.where("_after").count() > 0
    feed = {r["k"]: r["v"] for r in rows.collect()}
    for r in sorted(near.collect(), key=lambda r: r["pos"]):
        if r["op"] == "d":
            feed.pop(r["k"], None)
        else:
            feed[r["k"]] = r["pos"]
    assert feed == state
