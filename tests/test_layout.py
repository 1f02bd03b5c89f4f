"""Layout by two keys, moving re-shards, very many routes."""

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards
from lakesync.operators import fold, reshard
from lakesync.operators import routes as R
from lakesync.sinks import tables
from tests.helpers import rows


def groups_read(path, column, low, high):
    """Share of the row groups whose smallest and largest values do not rule out a range."""
    hit = total = 0
    for file in path.rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        at = next(i for i in range(meta.num_columns) if meta.schema.column(i).name == column)
        for g in range(meta.num_row_groups):
            stats = meta.row_group(g).column(at).statistics
            total += 1
            hit += stats.min <= high and stats.max >= low
    return hit / total


def test_interleaved_files_answer_both_filters(spark, tmp_path):
    n = 60_000
    mixed = F.pmod(F.col("id") * 7919, F.lit(n))
    frame = spark.range(n).select("id", F.expr("cast(pow(id, 1.3) as bigint)").alias("k"), mixed.alias("f_ts"))
    write = {"parquet.block.size": str(16 * 1024), "parquet.block.size.row.check.min": "100"}
    tables.interleaved(frame, ["k", "f_ts"], 32).write.options(**write).parquet(str(tmp_path / "two"))
    tables.sorted_by_key(frame, ["k"], 32).write.options(**write).parquet(str(tmp_path / "one"))
    two = groups_read(tmp_path / "two", "k", 5000, 5000), groups_read(tmp_path / "two", "f_ts", 100, 600)
    one = groups_read(tmp_path / "one", "k", 5000, 5000), groups_read(tmp_path / "one", "f_ts", 100, 600)
    # By key alone, a range of times reads everything; interleaved, a key and a range of times read a part each.
    assert one[1] > 0.9 and two[0] < 0.4 and two[1] < 0.4
    assert spark.read.parquet(str(tmp_path / "two")).agg(F.sum("id"), F.count("*")).first() == (n * (n - 1) // 2, n)


def test_moved_rows_are_those_that_differ(spark):
    frame = spark.createDataFrame([(i, i * 37 if i % 9 else None) for i in range(500)], f"id long, {shards.UID_FIELD} long")
    for old, new, n, m in (("TEN", "HUNDRED", 10, 100), ("HUNDRED", "TEN", 100, 10), ("ONE", "TEN", None, 10), ("TEN", "TEN", 10, 10)):
        name = lambda uid, count: f"t_{uid % count}" if count else "t"
        moved = reshard.moves(frame, "t", shards.UID_FIELD, old, new, file="bin.000001", pos=7)
        got = rows(moved.where("_reason is null"), "dst_table", "op", "id")
        uids = [(i, i * 37) for i in range(500) if i % 9]
        differ = [(i, u) for i, u in uids if name(u, n) != name(u, m)]
        want = [(name(u, n), S.DELETE, i) for i, u in differ] + [(name(u, m), S.INSERT, i) for i, u in differ]
        assert got == sorted(want, key=repr)
        assert moved.where("_reason is not null").count() == (len([i for i in range(500) if i % 9 == 0]))


def test_moved_rows_fold_into_the_new_shards(spark):
    """Shards after the moves, and after a change behind them, hold what routing by the new count gives."""
    frame = spark.createDataFrame([(i, i * 13) for i in range(200)], f"id long, {shards.UID_FIELD} long")
    uid = F.col(shards.UID_FIELD)

    def changes(df, table, op, pos, image):
        return df.select(
            F.concat(F.lit("t_"), table).alias("dst_table") if table is not None else F.col("dst_table"), "id", op.cast("tinyint").alias("op"),
            F.struct(image.alias("v")).alias("image"), F.lit("bin.000001").alias("file"), pos.cast("bigint").alias("pos"),
            F.lit(0).alias("row_no"), F.lit(1).cast("bigint").alias("ts_ms"), F.lit(True).alias("incremental"),
        )

    old = changes(frame, (uid % 10).cast("string"), F.lit(S.INSERT), F.col("id"), F.lit("old"))
    moved = reshard.moves(frame, "t", shards.UID_FIELD, "TEN", "HUNDRED", file="bin.000001", pos=1000)
    cut = changes(moved, None, F.col("op"), F.col("pos"), F.lit("old"))
    later = changes(frame.where("id % 7 = 0"), (uid % 100).cast("string"), F.lit(S.UPDATE_AFTER), F.lit(2000), F.lit("new"))
    feed = old.unionByName(cut).unionByName(later).select("dst_table", "id", "image", *S.bookkeeping())
    state = fold.fold(feed, ["dst_table", "id"], F.col("image"))
    got = rows(fold.current(state, ["dst_table", "id"], fold.MIGRATION), "dst_table", "id", "v")
    assert got == sorted([(f"t_{i * 13 % 100}", i, "new" if i % 7 == 0 else "old") for i in range(200)], key=repr)


def test_very_many_routes_leave_the_feed_in_place(spark, monkeypatch):
    routes = spark.range(200_000).select(
        F.lit("i0").alias("instance"), F.concat(F.lit("db_"), F.col("id") % 1000).alias("src_db"), F.concat(F.lit("t_"), F.col("id")).alias("src_table"),
        F.lit("d").alias("dst_db"), F.concat(F.lit("t_"), F.col("id")).alias("dst_table"),
    )
    named = spark.range(4000).select(
        F.lit("i0").alias("instance"), F.concat(F.lit("db_"), F.col("id") % 1000).alias("db"),
        F.concat(F.lit("t_"), F.when(F.col("id") % 3 == 0, 3).otherwise(F.col("id"))).alias("table"), F.lit(None).cast("string").alias("_reason"), "id",
    )

    def routed():
        out = R.route(named, routes)
        got = {r["id"]: (r["dst_table"], r["_reason"]) for r in out.collect()}
        return out._jdf.queryExecution().executedPlan().toString(), got

    plan, got = routed()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
    monkeypatch.setattr(R, "measured_broadcast", lambda df: df)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        other, same = routed()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in other and same == got
    for i, (table, reason) in got.items():
        wanted = 3 if i % 3 == 0 else i
        known = wanted % 1000 == i % 1000
        assert (table, reason) == ((f"t_{wanted}", None) if known else (None, R.UNROUTED))


def test_files_grow_with_the_table(spark, monkeypatch):
    """A task sorts one file, so a larger table gets more files and not larger ones."""
    monkeypatch.setattr(tables, "FILE_ROWS", 1000)
    for n, files in ((3000, 4), (12_000, 12)):
        frame = spark.range(n).select((F.col("id") * 7919 % n).alias("k"), F.col("id").alias("f_ts"))
        assert tables.sorted_by_key(frame, ["k"], 4).rdd.getNumPartitions() == files
        assert tables.interleaved(frame, ["k", "f_ts"], 4).rdd.getNumPartitions() == files
