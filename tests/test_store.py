import random

import pytest
from pyspark.sql import functions as F

from lakesync.functions.types import ColumnSpec
from lakesync.operators import ddl, fold
from lakesync.plans import sync
from lakesync.sinks import queue, tables
from lakesync.sinks.store import StateStore, _runs
from lakesync.sources import envelopes
from lakesync.streaming.sync import SyncJob
from tests.helpers import COLUMNS, ddl_doc, doc, docs, replay, rows

ROUTE = (
    "instance string, src_db string, src_table string, dst_db string, dst_table string, sharding boolean, "
    "shard_count int, shard_field string, batch_size int, nodata boolean, pk array<string>, keys array<string>, "
    "merge_fields boolean"
)


def routes(spark, **change):
    row = dict(
        instance="i0", src_db="shop_01_db", src_table="t_event_3", dst_db="d", dst_table="t", sharding=False,
        shard_count=1, shard_field=None, batch_size=1024, nodata=False, pk=["id"], keys=["id"], merge_fields=False,
    )
    return spark.createDataFrame([tuple({**row, **change}.values())], ROUTE)


def feed(seed, n=300, keys=25):
    rng = random.Random(seed)
    plain = [(rng.choice("cudu"), rng.randrange(keys), str(i)) for i in range(n)]
    return plain, [doc(op, {"id": k, "v": v}, file=f"bin.{9 + i // 50}", pos=i % 50) for i, (op, k, v) in enumerate(plain)]


def states(spark, lines, profile=fold.LAKE, route=None):
    routed = sync.routed_changes(docs(spark, lines), route or routes(spark))
    return sync.states(sync.targets(routed, profile), 5)


def test_compaction_expiry_and_late_batches(spark, tmp_path):
    plain, lines = feed(1)
    store = StateStore(spark, str(tmp_path / "s"))
    assert store.states().count() == 0 and store.expire() == []
    order = list(range(6))
    random.Random(3).shuffle(order)
    for step, b in enumerate(order):
        store.write_batch(b, states(spark, lines[b * 50:(b + 1) * 50]))
        if step in (1, 3, 4):
            store.compact(full=step == 3)
            store.expire()
    # The same batch again, after it was folded into the base.
    store.write_batch(50, states(spark, lines[:50]))
    got = rows(store.current("d", "t", COLUMNS, fold.LAKE), "id", "v")
    assert got == sorted(replay(plain, "lake").items(), key=repr)
    assert len(store.batches()) == 2 and store._published()["live"] == [[2, 3]]
    with pytest.raises(ValueError):
        store.compact(full=False, drop_deleted_before=(1, 1))


def test_uncommitted_batch_is_not_read(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, states(spark, [doc("c", {"id": 1, "v": "a"})]))
    store._write(states(spark, [doc("c", {"id": 2, "v": "b"})]), f"{store.root}/changes/batch_id=1")
    assert rows(store.current("d", "t", COLUMNS, fold.LAKE), "id") == [(1,)]


def test_deleted_markers_outlive_compaction_until_dropped(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, states(spark, [doc("c", {"id": 1, "v": "a"}, pos=1), doc("d", {"id": 1, "v": "a"}, pos=2)]))
    store.compact()
    store.write_batch(1, states(spark, [doc("c", {"id": 1, "v": "a"}, pos=1)]))
    assert store.current("d", "t", COLUMNS, fold.LAKE).count() == 0
    store.compact(drop_deleted_before=(1, 2))
    assert store.states().count() == 1
    store.compact(drop_deleted_before=(1, 3))
    assert store.states().count() == 0


def test_update_before_its_insert_in_an_earlier_batch(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, states(spark, [doc("u", {"id": 1, "v": "late"}, pos=2)], fold.MIGRATION))
    assert store.current("d", "t", COLUMNS, fold.MIGRATION).count() == 0
    store.write_batch(1, states(spark, [doc("c", {"id": 1, "v": "first"}, pos=1)], fold.MIGRATION))
    assert rows(store.current("d", "t", COLUMNS, fold.MIGRATION), "id", "v") == [(1, "late")]


def test_runs():
    assert _runs([1, 2, 3, 7, 9, 10]) == [[1, 3], [7, 7], [9, 10]] and _runs([]) == []
    assert _runs([4, 2], [[0, 1], [6, 8]]) == [[0, 2], [4, 4], [6, 8]] and _runs([5, 3], [[3, 4], [6, 8]]) == [[3, 8]]


def test_expired_batches_leave_no_marks(spark, tmp_path):
    store = StateStore(spark, str(tmp_path / "s"))
    part = states(spark, [doc("c", {"id": 1, "v": "a"}, pos=1)])
    for n in range(2):
        store.write_batch(n, part)
        store.compact()
    removed = store.expire()
    assert sorted(removed) == [
        "base/version=1", "changes/batch_id=0", "changes/batch_id=1", "commits/batch_id=0", "commits/batch_id=1", "versions/version=1",
    ]
    assert store.batches() == [] and store.expire() == []
    # A folded batch that comes again is known.
    store.write_batch(0, states(spark, [doc("d", {"id": 1, "v": "a"}, pos=9)]))
    assert store.batches() == [] and rows(store.current("d", "t", COLUMNS, fold.LAKE), "id") == [(1,)]


def test_same_key_in_two_shards(spark, tmp_path):
    both = routes(spark, sharding=True).unionByName(routes(spark, sharding=True, src_db="shop_02_db"))
    lines = [doc("c", {"id": 1, "v": "a"}), doc("c", {"id": 1, "v": "b"}, db="shop_02_db")]
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, states(spark, lines, route=both))
    got = rows(store.current("d", "t", COLUMNS, fold.LAKE, lineage=True), "db_name", "id", "v")
    assert got == [("shop_01_db", 1, "a"), ("shop_02_db", 1, "b")]


def test_migration_targets(spark):
    route = routes(spark, sharding=True, shard_count=10, shard_field="Fuid", merge_fields=True)
    lines = [
        doc("c", {"id": 1, "Fuid": 13}), doc("c", {"id": 2, "Fuid": -1}), doc("c", {"Fuid": 5}), ddl_doc("x"),
    ]
    out = sync.migration_targets(sync.routed_changes(docs(spark, lines), route))
    assert rows(out, "op", "dst_table", "key", "_reason") == [
        (0, "t", ["2", "01", "3"], "bad_shard_key"), (0, "t_3", ["1", "01", "3"], None),
        (0, "t_5", [None, "01", "3"], "missing_key"), (4, "t", None, None),
    ] or {r[3] for r in rows(out, "op", "dst_table", "key", "_reason")} == {None, "bad_shard_key", "missing_key"}
    order = routes(spark, shard_count=100, shard_field="Frc_order_id")
    out = sync.migration_targets(sync.routed_changes(docs(spark, [doc("c", {"id": 1, "Frc_order_id": "ORD123987"})]), order))
    assert rows(out, "dst_table") == [("t_87",)]


def test_merge_indexes_in_the_typed_rows(spark, tmp_path):
    route = routes(spark, sharding=True, merge_fields=True)
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, states(spark, [doc("c", {"id": 1, "v": "a"})], fold.MIGRATION, route))
    got = store.current("d", "t", COLUMNS, fold.MIGRATION, merge_indexes=True)
    assert rows(got, "id", "db_index", "table_index") == [(1, "01", "3")]


@pytest.mark.parametrize("files", [1, 2, 7])
@pytest.mark.parametrize("profile", [fold.LAKE, fold.MIGRATION])
def test_stream_equals_batch_in_any_cut(spark, tmp_path, files, profile):
    plain, lines = feed(7, n=140)
    random.Random(4).shuffle(lines)
    for n in range(files):
        docs(spark, lines[n::files]).coalesce(1).write.text(str(tmp_path / f"in/{n}"))
    job = SyncJob(routes(spark), str(tmp_path / "s"), profile, f_ts=5)
    stream = spark.readStream.format("text").option("maxFilesPerTrigger", "1").load(str(tmp_path / "in/*"))
    job.start(stream, str(tmp_path / "ck"), interval=None).awaitTermination()
    store = StateStore(spark, job.root)
    assert len(store.batches()) == files
    expected = sorted(replay(plain, profile).items(), key=repr)
    assert rows(store.current("d", "t", COLUMNS, profile), "id", "v") == expected
    # A batch repeated under its own id or a new one changes nothing.
    again = docs(spark, lines[0::files])
    job.process(again, 0)
    job.process(again, 77)
    assert rows(store.current("d", "t", COLUMNS, profile), "id", "v") == expected


def test_outputs_of_a_batch(spark, tmp_path):
    lines = [
        doc("c", {"id": 1, "v": "a"}, pos=1), doc("d", {"id": 2, "v": "b"}, pos=2), doc("c", {"id": 3}, db="zz"),
        ddl_doc("ALTER TABLE t ADD c INT", pos=3), ddl_doc("ALTER TABLE t ADD c INT", file=""), "broken",
    ]
    job = SyncJob(routes(spark), str(tmp_path / "s"), send_messages=True, drop_deletes=True, application="app")
    job.process(docs(spark, lines), 0)
    read = spark.read
    assert rows(read.parquet(f"{job.root}/quarantine"), "reason", "document") == [
        ("blank_offset", None), ("malformed", "broken"), ("unrouted", None),
    ]
    assert rows(read.parquet(f"{job.root}/ddl_log"), "pos", "dst_table") == [(3, "t")]
    assert rows(read.parquet(f"{job.root}/deletes"), "application", "row_json") == [("app", '{"id":2,"v":"b"}')]
    sent = read.json(f"{job.root}/messages")
    assert rows(sent, "topic", "key", "value") == [
        ("flink.d.t", '["1"]', '{"op":0,"row":{"id":1,"v":"a"}}'), ("flink.d.t", '["2"]', '{"op":3,"row":{"id":2,"v":"b"}}'),
    ]
    live = StateStore(spark, job.root).current("d", "t", COLUMNS, fold.LAKE, sync_time=True)
    row = live.first()
    assert live.count() == 1 and row["f_ts"] > 1_700_000_000_000


def test_message_files_follow_the_log(spark, tmp_path):
    plain, lines = feed(9, n=200)
    random.Random(1).shuffle(lines)
    out = queue.messages(sync.routed_changes(docs(spark, lines), routes(spark)), "PROD")
    queue.write_files(out, str(tmp_path / "m"))
    read = spark.read.json(str(tmp_path / "m")).select(
        F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"),
        F.get_json_object("value", "$.row.v").cast("int").alias("n"),
    )
    assert [r.n for r in read.orderBy("f", "i").collect()] == list(range(200))


SPECS = [
    ColumnSpec("id", "BIGINT", is_pk=True, comment="it's \\ the key", is_autoincrement=True),
    ColumnSpec("Fuid", "BIGINT"), ColumnSpec("when", "DATETIME", comment="c"),
]


def test_target_schema():
    schema = tables.target_schema(SPECS, sharded=True)
    assert schema.names == ["db_name", "table_name", "id", "Fuid", "when", "f_ts"]
    assert [f.nullable for f in schema] == [False, False, False, True, True, True]
    assert schema["id"].metadata["comment"] == "it's \\ the key"


def test_create_table_once(spark):
    schema = tables.target_schema(SPECS)
    assert not tables.exists(spark, "ods_made", "t")
    assert tables.create_table(spark, "ods_made", "t", schema)
    assert not tables.create_table(spark, "ods_made", "t", schema)
    made = spark.table("ods_made.t")
    assert made.schema.names == schema.names and made.schema["id"].metadata["comment"] == "it's \\ the key"
    options = spark.sql("SHOW CREATE TABLE ods_made.t").first()[0]
    assert "parquet.bloom.filter.enabled#f_ts" in options


def test_create_clones(spark):
    made = tables.create_clones(spark, "moved", "t", SPECS, "TEN")
    assert made == [f"t_{i}" for i in range(10)]
    assert spark.table("moved.t_3").columns == ["id", "db_index", "table_index", "Fuid", "when"]
    assert tables.create_clones(spark, "moved", "t", SPECS, "TEN") == []
    assert tables.create_clones(spark, "moved", "one", SPECS, None, sharding=False) == ["one"]
    with pytest.raises(ValueError):
        tables.create_clones(spark, "moved", "x", [ColumnSpec("a")], None)
    with pytest.raises(ValueError):
        tables.create_clones(spark, "moved", "x", [ColumnSpec("a", is_pk=True)], "TEN")
    assert tables.create_clones(spark, "moved", "y", [ColumnSpec("a", is_pk=True)], "TEN", nodata=True)


def test_sorted_layout(spark, tmp_path):
    frame = spark.range(1000).withColumn("k", F.col("id") * 7919 % 1000)
    tables.sorted_by_key(frame, ["k"], 4).write.parquet(str(tmp_path / "o"))
    read = spark.read.parquet(str(tmp_path / "o")).groupBy(F.input_file_name().alias("f")).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    spans = sorted((r.lo, r.hi) for r in read.collect())
    assert len(spans) == 4 and all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_split_by_target(spark, tmp_path):
    frame = spark.createDataFrame([("d", "a", 1), ("d", "b", 2)], "dst_db string, dst_table string, x int")
    tables.split_by_target(frame, str(tmp_path / "o"))
    assert rows(spark.read.parquet(str(tmp_path / "o/dst_db=d/dst_table=b"))) == [(2,)]


def test_job_checks_its_routes(spark, tmp_path):
    with pytest.raises(ValueError, match="without a key: shop_01_db.t_event_3"):
        SyncJob(routes(spark, pk=[], keys=["u"]), str(tmp_path))
    SyncJob(routes(spark, pk=[], keys=["u"]), str(tmp_path), fold.MIGRATION)
    with pytest.raises(ValueError, match="1 duplicate_source"):
        SyncJob(routes(spark).unionByName(routes(spark)), str(tmp_path))


def test_current_rows_across_a_rename(spark, tmp_path):
    lines = [doc("c", {"id": 1, "v": "before"}, pos=1), doc("c", {"id": 2, "w": "after"}, pos=30)]
    job = SyncJob(routes(spark), str(tmp_path / "s"))
    job.process(docs(spark, [*lines, ddl_doc("ALTER TABLE t CHANGE v w VARCHAR(9) FIRST", pos=20)]), 0)
    job.process(docs(spark, [ddl_doc("ALTER TABLE t CHANGE v w VARCHAR(9) FIRST", pos=20)]), 1)
    log = ddl.read_log(spark, job.root)
    assert log.count() == 1
    evolution = ddl.evolve_from_log(COLUMNS, log, "d", "t")
    got = StateStore(spark, job.root).current_evolved("d", "t", evolution, fold.LAKE)
    assert got.columns == ["w", "id"] and rows(got) == [("after", 2), ("before", 1)]


def test_rows_that_do_not_fit_are_reported_whole(spark, tmp_path):
    columns = [ColumnSpec("id", "BIGINT", is_pk=True), ColumnSpec("v", "INT")]
    store = StateStore(spark, str(tmp_path / "s"))
    store.write_batch(0, states(spark, [doc("c", {"id": 1, "v": 5}), doc("c", {"id": 2, "v": "five"})]))
    assert rows(store.current("d", "t", columns, fold.LAKE), "id", "v") == [(1, 5)]
    bad = store.current_rejected("d", "t", columns, fold.LAKE)
    assert rows(bad, "reason", "db", F.to_json("row")) == [("bad_cast", "shop_01_db", '{"id":2,"v":"five"}')]


def test_read_envelopes(spark, tmp_path):
    docs(spark, [doc("c", {"id": 1})]).write.text(str(tmp_path / "x"))
    assert envelopes.read_envelopes(spark, str(tmp_path / "x")).columns == ["value"]


def test_ddl_log_folders(spark, tmp_path):
    """Batches without DDL leave no folder; merging leaves one, at any time, with the same events."""
    job = SyncJob(routes(spark), str(tmp_path / "s"))
    assert ddl.read_log(spark, job.root).count() == 0
    for n in range(5):
        lines = [doc("c", {"id": n, "v": "a"}, pos=n)] + ([ddl_doc(f"ALTER TABLE t ADD c{n} INT", pos=100 + n)] if n in (1, 3) else [])
        job.process(docs(spark, lines), n)
    folders = lambda: sorted(p.name for p in (tmp_path / "s" / "ddl_log").iterdir())
    assert folders() == ["batch_id=1", "batch_id=3"]
    want = rows(ddl.read_log(spark, job.root), "pos", "ddl")
    ddl.merge_log(spark, job.root)
    assert folders() == ["batch_id=-1"] and rows(ddl.read_log(spark, job.root), "pos", "ddl") == want
    job.process(docs(spark, [ddl_doc("ALTER TABLE t ADD c9 INT", pos=109)]), 9)
    job.process(docs(spark, [ddl_doc("ALTER TABLE t ADD c3 INT", pos=103)]), 3)
    ddl.merge_log(spark, job.root)
    assert folders() == ["batch_id=-2"]
    assert rows(ddl.read_log(spark, job.root), "pos", "ddl") == sorted([*want, (109, "ALTER TABLE t ADD c9 INT")], key=repr)


def test_one_full_base_is_read_without_a_merge(spark, tmp_path):
    job = SyncJob(routes(spark), str(tmp_path / "s"))
    for n in range(2):
        job.process(docs(spark, [doc("c", {"id": i, "v": f"{n}"}, pos=10 * n + i) for i in range(5)]), n)
    store = StateStore(spark, job.root)
    want = rows(store.current("d", "t", COLUMNS, fold.LAKE), "id", "v")
    store.compact()
    after = store.current("d", "t", COLUMNS, fold.LAKE)
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert rows(after, "id", "v") == want and "Aggregate" not in plan and "Exchange" not in plan
    job.process(docs(spark, [doc("u", {"id": 2, "v": "new"}, pos=99)]), 2)
    assert (2, "new") in rows(store.current("d", "t", COLUMNS, fold.LAKE), "id", "v")
