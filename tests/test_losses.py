"""Changes that must not get lost without a word: one test for each way it can happen."""

import pytest
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import ddl, decode, fold, quality
from lakesync.plans import layers, sync
from lakesync.sinks import queue
from lakesync.sinks.store import StateStore
from lakesync.streaming.sync import SyncJob
from tests.helpers import COLUMNS, doc, docs, rows
from tests.test_store import routes, states

UNIQUE = [ColumnSpec("id", "BIGINT", is_uk=True), ColumnSpec("v", "VARCHAR")]
LOGS = "instance string, base string, generation int"


def test_null_unique_keys_are_set_aside_and_key_changes_move_the_row(spark):
    lines = [
        doc("c", {"id": None, "v": "a"}, pos=1), doc("c", {"id": None, "v": "b"}, pos=2), doc("c", {"id": 1, "v": "c"}, pos=3),
        doc("u", {"id": 2, "v": "d"}, before={"id": 1, "v": "c"}, pos=4),
    ]
    assert rows(sync.current_rows(docs(spark, lines), UNIQUE, fold.MIGRATION), "id", "v") == [(2, "d")]
    bad = quality.quarantined(sync.typed_changes(docs(spark, lines), UNIQUE))
    assert rows(bad, "reason", "v") == [("missing_key", "a"), ("missing_key", "b")]


def test_an_update_can_move_a_row_to_another_shard(spark):
    route = routes(spark, sharding=True, shard_count=10, shard_field="Fuid")
    lines = [
        doc("c", {"id": 1, "Fuid": 3}, pos=1), doc("u", {"id": 1, "Fuid": 7}, before={"id": 1, "Fuid": 3}, pos=2),
        doc("c", {"id": 2, "Fuid": 5}, pos=3), doc("u", {"id": 2, "Fuid": 5}, before={"id": 2, "Fuid": 5}, pos=4),
    ]
    net = states(spark, lines, fold.MIGRATION, route)
    assert rows(net, "dst_table", F.col("key")[0], fold.action(fold.MIGRATION)) == [
        ("t_3", "1", "delete"), ("t_5", "2", "upsert"), ("t_7", "1", "upsert"),
    ]


def test_field_names_with_quotes_find_their_key(spark):
    frame = spark.createDataFrame([("""{"it's":1,"a\\"b":2}""", "it's"), ('{"a":1}', "a")], "t string, n string")
    got = frame.select(sync.named_field(F.parse_json("t"), F.col("n")).alias("x"))
    assert [r.x for r in got.collect()] == ["1", "1"]


def test_files_of_a_later_log_count_on(spark):
    logs = spark.createDataFrame([("i0", "bin.", 0), ("i0", "newhost-bin.", 1)], LOGS)
    lines = [
        doc("c", {"id": 1, "v": "old"}, file="bin.000900"), doc("u", {"id": 1, "v": "new"}, file="newhost-bin.000002"),
        doc("u", {"id": 1, "v": "lost"}, file="third-bin.000001"),
    ]
    assert rows(sync.current_rows(docs(spark, lines), COLUMNS, fold.LAKE, logs=logs), "v") == [("new",)]
    set_aside = decode.continued(decode.decode(docs(spark, lines)), logs).where("_reason is not null")
    assert rows(set_aside, "file", "_reason") == [("third-bin.000001", decode.UNKNOWN_LOG)]


def test_a_second_log_stops_the_job_unless_listed(spark, tmp_path):
    job = SyncJob(routes(spark), str(tmp_path / "a"))
    job.process(docs(spark, [doc("c", {"id": 1, "v": "a"}, file="bin.000900")]), 0)
    later = docs(spark, [doc("u", {"id": 1, "v": "b"}, file="newhost-bin.000002")])
    with pytest.raises(ValueError, match="second log 'newhost-bin.'"):
        job.process(later, 1)
    logs = spark.createDataFrame([("i0", "bin.", 0), ("i0", "newhost-bin.", 1)], LOGS)
    job = SyncJob(routes(spark), str(tmp_path / "b"), logs=logs)
    job.process(docs(spark, [doc("c", {"id": 1, "v": "a"}, file="bin.000900")]), 0)
    job.process(later, 1)
    assert rows(StateStore(spark, job.root).current("d", "t", COLUMNS, fold.LAKE), "v") == [("b",)]


def test_a_store_refuses_batches_of_another_query(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    one = states(spark, [doc("c", {"id": 1, "v": "a"})])
    store.write_batch(0, one, "q1")
    store.write_batch(1, one, "q1")
    store.compact()
    store.expire()
    with pytest.raises(ValueError, match="batches of query q1"):
        store.write_batch(0, states(spark, [doc("c", {"id": 2, "v": "b"})]), "q2")
    store.write_batch(2, one, "q1")


def test_a_lost_checkpoint_is_noticed(spark, tmp_path):
    docs(spark, [doc("c", {"id": 1, "v": "a"})]).coalesce(1).write.text(str(tmp_path / "in"))
    source = spark.readStream.format("text").load(str(tmp_path / "in"))
    job = SyncJob(routes(spark), str(tmp_path / "s"))
    job.start(source, str(tmp_path / "one"), interval=None).awaitTermination()
    with pytest.raises(Exception, match="holds batches of query"):
        job.start(source, str(tmp_path / "two"), interval=None).awaitTermination()


def test_unsharded_merges_and_several_instances_need_consent(spark, tmp_path):
    merged = routes(spark).unionByName(routes(spark, src_db="shop_02_db"))
    with pytest.raises(ValueError, match="unsharded_merge d.t"):
        SyncJob(merged, str(tmp_path / "a"))
    SyncJob(merged, str(tmp_path / "b"), allow=["unsharded_merge"])
    two = routes(spark, sharding=True).unionByName(routes(spark, instance="i1", sharding=True))
    with pytest.raises(ValueError, match="several_instances d.t"):
        SyncJob(two, str(tmp_path / "c"))
    job = SyncJob(two, str(tmp_path / "d"), allow=["several_instances"])
    lines = [doc("c", {"id": 1, "v": "a"}, pos=9), doc("c", {"id": 1, "v": "b"}, instance="i1", pos=1)]
    job.process(docs(spark, lines), 0)
    assert rows(StateStore(spark, job.root).current("d", "t", COLUMNS, fold.LAKE), "v") == [("a",), ("b",)]


def test_batches_read_no_catalog(spark, tmp_path):
    routes(spark).write.parquet(str(tmp_path / "catalog"))
    job = SyncJob(spark.read.parquet(str(tmp_path / "catalog")), str(tmp_path / "s"))
    plan = sync.routed_changes(docs(spark, [doc("c", {"id": 1})]), job.routes, check_size=False)._jdf.queryExecution().toString()
    assert "FileScan" not in plan and "catalog" not in plan


def test_digests_see_which_column_is_null(spark):
    one, other = (spark.createDataFrame([r], "g int, a string, b string") for r in ((1, "x", None), (1, None, "x")))
    assert quality.reconcile_digests(one, other, ["g"]).count() == 1
    assert quality.reconcile_digests(one, one, ["g"]).count() == 0


def test_status_is_per_event(spark):
    log = spark.createDataFrame(
        [("d", "t", "ALTER TABLE t ADD c INT", "bin.1", 1, 1), ("d", "t", "CREATE INDEX i ON t (v)", "bin.1", 2, 2), ("d", "t", "ALTER TABLE t ADD c INT", "bin.1", 3, 3)],
        "dst_db string, dst_table string, ddl string, file string, pos bigint, ts_ms bigint",
    )
    got = ddl.evolution_status(log, ddl.evolve_from_log(COLUMNS, log, "d", "t"))
    assert rows(got, "pos", "status") == [(1, "applied"), (2, "unchanged"), (3, "unchanged")]


def test_deletes_reach_the_downstream_table(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, sync.states(sync.lake_targets(sync.routed_changes(docs(spark, [doc("c", {"id": i, "v": "a"}, pos=i) for i in (1, 2, 3)]), routes(spark))), 1))
    dwd = spark.createDataFrame([(i, "a") for i in (1, 2, 3)], "id bigint, v string")
    store.write_batch(1, sync.states(sync.lake_targets(sync.routed_changes(docs(spark, [doc("d", {"id": 2, "v": "a"}, pos=9)]), routes(spark))), 2))
    store.compact()
    gone = store.deleted_keys("d", "t", COLUMNS, fold.LAKE, 1)
    assert rows(gone) == [(2,)] and store.deleted_keys("d", "t", COLUMNS, fold.LAKE, 2).count() == 0
    ods = store.current("d", "t", COLUMNS, fold.LAKE, sync_time=True).withColumn(S.IS_DEL, F.lit(0))
    assert rows(layers.clean_apply(dwd, ods, ["id"], 1, gone)) == [(1, "a"), (3, "a")]


def test_messages_of_a_key_are_sent_in_order(spark):
    lines = [doc("u", {"id": i % 5, "v": str(i)}, pos=i) for i in range(100)]
    out = queue.in_key_order(queue.messages(sync.routed_changes(docs(spark, lines), routes(spark)).repartition(7), "TEST"))
    tasks = out.withColumn("task", F.spark_partition_id()).withColumn("n", F.monotonically_increasing_id())
    got = sorted((r.n, r.key, r.task, r.position.pos) for r in tasks.collect())
    for key in {k for _, k, _, _ in got}:
        own = [(t, p) for _, k, t, p in got if k == key]
        assert len({t for t, _ in own}) == 1 and [p for _, p in own] == sorted(p for _, p in own)
