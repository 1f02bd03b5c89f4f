"""Plans that must hold at scale: what shuffles, what is pushed down, what a hot key costs."""

import re

import pytest
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import decode, fold, history, quality
from lakesync.operators.typed import typed_rows
from lakesync.plans import layers, sync
from lakesync.sinks import tables
from lakesync.sources import envelopes
from tests.helpers import COLUMNS, doc, docs, rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    """Shuffles by hash or range; broadcasts do not count."""
    return len(re.findall(r"Exchange (?:hash|range)partitioning", plan(df)))


@pytest.fixture
def no_auto_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def typed(spark, lines):
    return quality.accepted(sync.typed_changes(docs(spark, lines), COLUMNS))


def test_fold_shuffles_once_after_partial_aggregation(spark):
    df = fold.fold(typed(spark, [doc("c", {"id": 1})]), ["id"])
    text = plan(df)
    assert shuffles(df) == 1
    assert text.index("Exchange hashpartitioning") < text.index("partial_max_by")


def test_hot_key_leaves_one_row_per_map_task(spark, tmp_path):
    n = 20_000
    feed = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") + 100).alias("k"), F.col("id").alias("pos")
    )
    changes = feed.select(
        "k", F.lit(2).cast("tinyint").alias(S.CHANGE_OP),
        F.struct(F.lit(True).alias("incremental"), F.lit(1).cast("bigint").alias("file_no"), "pos", F.lit(0).alias("row_no")).alias(S.CHANGE_ORD),
        F.col("pos").alias("v"),
    )
    states = fold.fold(changes, ["k"])
    states.write.parquet(str(tmp_path / "s"))
    hot = spark.read.parquet(str(tmp_path / "s")).where("k = 7").first()
    assert hot["image"]["v"] == max(i for i in range(n) if i % 3 == 0)
    assert states.count() == n - len(range(0, n, 3)) + 1


def test_history_of_a_hot_key(spark):
    lines = [doc("u", {"id": 1 if n % 3 else n + 10}, file=f"bin.{n // 50}", pos=n, ts_ms=n + 1) for n in range(600)]
    changes = decode.decode(docs(spark, lines)).withColumn("id", F.try_variant_get("row", "$.id", "int"))
    out = history.change_history(changes, ["id"])
    # Rows are only ever gathered by key and chunk; whole keys meet as summaries.
    windows = re.findall(r"Window \[row_number\(\).*?\], \[([^\]]*)\]", plan(out))
    assert windows and all("_chunk" in w for w in windows)
    hot = [r for r in rows(out, "id", "version", "valid_from", "valid_to") if r[0] == 1]
    assert [r[1] for r in sorted(hot, key=lambda r: r[1])] == list(range(1, 401))
    ordered = sorted(hot, key=lambda r: r[1])
    assert [r[3] for r in ordered[:-1]] == [r[2] for r in ordered[1:]] and ordered[-1][3] is None


def test_small_stored_batch_does_not_move_the_target(spark, tmp_path):
    old = spark.range(1000).select("id", F.col("id").cast("string").alias("v"))
    old.write.parquet(str(tmp_path / "t"))
    fold.fold(typed(spark, [doc("u", {"id": 3, "v": "x"})]), ["id"]).write.parquet(str(tmp_path / "n"))
    net = spark.read.parquet(str(tmp_path / "n"))
    out = fold.apply_stored(spark.read.parquet(str(tmp_path / "t")), net, ["id"], fold.MIGRATION)
    assert shuffles(out) == 0 and out.where("id = 3").first()["v"] == "x" and out.count() == 1000


def test_bucketed_target_joins_in_place(spark, no_auto_broadcast):
    schema = tables.target_schema([ColumnSpec("id", "BIGINT", is_pk=True), ColumnSpec("v")], sync_time=False)
    tables.create_table(spark, "ods_bucketed", "t", schema, keys=["id"], buckets=4)
    old = spark.range(1000).select("id", F.col("id").cast("string").alias("v"))
    old.write.insertInto("ods_bucketed.t")
    net = fold.fold(typed(spark, [doc("d", {"id": 3, "v": "x"})]), ["id"])
    out = fold.apply(spark.table("ods_bucketed.t"), net, ["id"], fold.LAKE)
    text = plan(out)
    target_side = text[: text.index("Scan parquet spark_catalog.ods_bucketed.t")].rsplit("SortMergeJoin", 1)[1]
    assert "Exchange" not in target_side
    assert out.count() == 999


def test_increment_filter_reaches_the_scan(spark, tmp_path):
    ods = spark.range(10).select("id", F.col("id").alias("f_ts"), F.lit(0).alias("is_del"), F.lit("x").alias("v"))
    ods.write.parquet(str(tmp_path / "o"))
    text = plan(layers.increment(spark.read.parquet(str(tmp_path / "o")), 5).select("id"))
    assert "GreaterThan(f_ts,5)" in text and "ReadSchema: struct<id:bigint,f_ts:bigint>" in text


def test_documents_are_parsed_once(spark):
    text = plan(typed(spark, [doc("c", {"id": 1})]))
    assert len(re.findall(r"from_json\(StructField\(instance", text)) == 1
    assert len(re.findall(r"try_variant_get\([^()]*\['id'\], LongType", text)) == 1


def test_landed_layout_reads_only_wanted_tables(spark, tmp_path):
    lines = [doc("c", {"id": n}, table=f"t{n % 5}") for n in range(50)] + ["broken"]
    envelopes.land(docs(spark, lines), str(tmp_path / "l"))
    assert envelopes.read_landed(spark, str(tmp_path / "l")).count() == 51
    wanted = spark.createDataFrame([("shop_01_db", "t3")], "db string, table string")
    out = envelopes.read_landed(spark, str(tmp_path / "l"), wanted)
    assert "dynamicpruning" in plan(out).lower()
    assert out.count() == 10


def test_key_delete_uses_one_partitioning(spark, no_auto_broadcast):
    table, gone = spark.range(100), spark.range(50).withColumn("x", F.lit(1))
    # One shuffle per side: the distinct keys already lie where the join wants them.
    assert shuffles(tables.delete_keys(table, gone, ["id"])) <= 2


def test_typed_rows_stay_in_the_jvm(spark):
    text = plan(typed_rows(decode.decode(docs(spark, [doc("c", {"id": 1})])), COLUMNS))
    assert "Python" not in text and "Exchange" not in text
