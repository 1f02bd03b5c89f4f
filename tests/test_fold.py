import random

import pytest
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import decode, fold, history, quality
from lakesync.plans import layers, sync
from lakesync.sinks import jdbc, tables
from tests.helpers import COLUMNS, doc, docs, replay, rows

CASES = {
    "insert": ["c1"],
    "insert delete": ["c1", "d1"],
    "delete update": ["d1", "u2"],
    "insert update delete insert": ["c1", "u2", "d2", "c3"],
    "update only": ["u1"],
    "delete only": ["d1"],
    "update delete insert update": ["u1", "d1", "c2", "u3"],
    "snapshot and log": ["r1", "u2", "u3"],
}


def feed_of(cases):
    """Envelope lines and (op, id, v) in log order, one key per case."""
    lines, plain = [], []
    for key, steps in enumerate(cases.values()):
        for n, step in enumerate(steps):
            op, value = step[0], step[1]
            lines.append(doc(op, {"id": key, "v": value}, pos=n, ts_ms=0 if op == "r" else 1))
            plain.append((op, key, value))
    return lines, plain


def typed(spark, lines):
    return quality.accepted(sync.typed_changes(docs(spark, lines), COLUMNS))


def target(spark, keys):
    return spark.createDataFrame([(k, "t") for k in keys], "id bigint, v string")


@pytest.mark.parametrize("profile", [fold.LAKE, fold.MIGRATION])
@pytest.mark.parametrize("present", [False, True])
def test_apply_equals_replay(spark, profile, present):
    lines, plain = feed_of(CASES)
    random.Random(5).shuffle(lines)
    before = {k: "t" for k in range(len(CASES))} if present else {}
    expected = sorted(replay(plain, profile, before).items())
    states = fold.fold(typed(spark, lines), ["id"])
    old = target(spark, before)
    for way in (fold.apply, fold.apply_stored):
        assert rows(way(old, states, ["id"], profile), "id", "v") == expected
    merged = fold.merge(fold.seed(old, ["id"]).unionByName(states), ["id"])
    assert rows(fold.current(merged, ["id"], profile), "id", "v") == expected


@pytest.mark.parametrize("profile", [fold.LAKE, fold.MIGRATION])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scattered_and_replayed_batches(spark, profile, seed):
    rng = random.Random(seed)
    plain = [(rng.choice("cudu"), rng.randrange(40), str(n)) for n in range(400)]
    lines = [doc(op, {"id": k, "v": v}, file=f"bin.{999_990 + n // 20}", pos=n % 20) for n, (op, k, v) in enumerate(plain)]
    batches = [[] for _ in range(7)]
    for line in lines:
        batches[rng.randrange(7)].append(line)
    states = None
    for b in [*batches, batches[3]]:
        part = fold.fold(typed(spark, b), ["id"])
        states = part if states is None else states.unionByName(part)
    got = rows(fold.current(fold.merge(states, ["id"]), ["id"], profile), "id", "v")
    assert got == sorted(replay(plain, profile).items(), key=repr)


def test_position_decides_not_text_order(spark):
    lines = [
        doc("u", {"id": 1, "v": "new"}, file="bin.1000000", pos=1),
        doc("u", {"id": 1, "v": "old"}, file="bin.999999", pos=9),
        doc("u", {"id": 2, "v": "second"}, pos=7, no=1),
        doc("u", {"id": 2, "v": "first"}, pos=7, no=0),
        doc("c", {"id": 3, "v": "log"}, pos=1),
        doc("r", {"id": 3, "v": "snap"}, ts_ms=0, file="bin.9999999", pos=99),
    ]
    got = rows(fold.current(fold.fold(typed(spark, lines), ["id"]), ["id"], fold.LAKE), "id", "v")
    assert got == [(1, "new"), (2, "second"), (3, "log")]


def test_old_insert_after_delete_stays_deleted(spark):
    lines = [doc("c", {"id": 1, "v": "a"}, pos=1), doc("d", {"id": 1, "v": "a"}, pos=2), doc("c", {"id": 1, "v": "a"}, pos=1)]
    states = fold.fold(typed(spark, lines), ["id"])
    for profile in (fold.LAKE, fold.MIGRATION):
        assert fold.current(states, ["id"], profile).count() == 0


def test_all_key_table(spark):
    columns = [ColumnSpec("a", "INT", is_pk=True), ColumnSpec("b", "INT", is_pk=True)]
    lines = [doc("c", {"a": 1, "b": 2}, pos=0), doc("u", {"a": 3, "b": 4}, pos=1), doc("d", {"a": 1, "b": 2}, pos=2)]
    states = fold.fold(quality.accepted(sync.typed_changes(docs(spark, lines), columns)), ["a", "b"], F.lit(True))
    live = states.where(fold.action(fold.LAKE) == fold.UPSERT)
    assert rows(live, "a", "b") == [(3, 4)]


def test_bookkeeping_does_not_clash_with_source_columns(spark):
    columns = [ColumnSpec("id", "INT", is_pk=True)] + [ColumnSpec(n) for n in ("op", "row", "pos", "file", "reason", "table")]
    row = {"id": 1, "op": "o", "row": "r", "pos": "p", "file": "f", "reason": "why", "table": "t"}
    got = rows(sync.current_rows(docs(spark, [doc("c", row)]), columns, fold.LAKE))
    assert got == [(1, "o", "r", "p", "f", "why", "t")]


def test_key_choice():
    pk, uk, plain = ColumnSpec("a", is_pk=True), ColumnSpec("b", is_uk=True), ColumnSpec("c")
    assert fold.key_columns([pk, uk, plain], lake=True) == ["a"]
    assert fold.key_columns([pk, plain], lake=True, sharded=True) == ["db_name", "table_name", "a"]
    assert fold.key_columns([uk, plain], lake=False) == ["b"]
    for columns, lake in (([uk, plain], True), ([plain], False)):
        with pytest.raises(ValueError):
            fold.key_columns(columns, lake=lake)
    with pytest.raises(ValueError):
        fold.action("other")


def test_key_violations_report_nulls(spark):
    frame = spark.createDataFrame([(1, 1), (1, 1), (2, None), (3, 3)], "a int, b int")
    assert rows(fold.key_violations(frame, ["a", "b"])) == [(1, 1, 2), (2, None, 1)]


def test_history_spans_chunks(spark):
    lines = [doc("u", {"id": n % 2, "v": str(n)}, file=f"bin.{n // 4}", pos=n, ts_ms=100 + n) for n in range(16)]
    random.Random(2).shuffle(lines)
    changes = decode.decode(docs(spark, lines)).withColumn("id", F.try_variant_get("row", "$.id", "int"))
    got = rows(history.change_history(changes, ["id"]), "id", "version", "valid_from", "valid_to")
    expected = [
        (k, i + 1, 100 + k + 2 * i, 102 + k + 2 * i if i < 7 else None) for k in (0, 1) for i in range(8)
    ]
    assert got == sorted(expected, key=repr)


def test_key_delete_with_repeated_keys(spark):
    table = spark.createDataFrame([(i, "x") for i in range(6)], "id int, v string")
    gone = spark.createDataFrame([(1,)] * 50 + [(4,)], "id int")
    assert rows(tables.delete_keys(table, gone, ["id"]), "id") == [(0,), (2,), (3,), (5,)]


def test_clean_layer(spark):
    ods = spark.createDataFrame(
        [(1, "new", 20, 0), (2, "gone", 20, 1), (3, "old", 5, 0), (4, "added", 20, None)], "id int, v string, f_ts bigint, is_del int"
    )
    dwd = spark.createDataFrame([(1, "was", 1), (2, "was", 1), (3, "old", 5)], "id int, v string, f_ts bigint")
    assert rows(layers.clean_apply(dwd, ods, ["id"], since=10), "id", "v") == [(1, "new"), (3, "old"), (4, "added")]
    assert layers.latest_sync(ods).first()[0] == 20


def test_reconcile_counts_duplicates(spark):
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (2,), (2,)], "x int")
    assert rows(quality.reconcile(a, b)) == [(1, "source_only", 1), (2, "target_only", 1), (None, "source_only", 1)]
    assert quality.reconcile_digests(a.withColumn("g", F.lit(1)), b.withColumn("g", F.lit(1)), ["g"]).count() == 1


def test_staging_statements():
    out = jdbc.statements("d.t", "d.s", ["id", "v"], ["id"])
    assert out[0] == "DELETE t FROM d.t t JOIN d.s s ON t.`id` = s.`id` WHERE s.`action` = 'delete'"
    assert "SET t.`v` = s.`v`" in out[1]
    assert out[2].endswith("WHERE `action` = 'upsert' ON DUPLICATE KEY UPDATE `v` = VALUES(`v`)")
    only_keys = jdbc.statements("d.t", "d.s", ["id"], ["id"])
    assert len(only_keys) == 2 and "UPDATE d.t" not in " ".join(only_keys)
    assert jdbc.staging_table("d", "t", 7) == "d.stage_t_7"
    assert jdbc.write_options("u", "t")["batchsize"] == "1024"


def test_order_key_of_missing_position(spark):
    frame = spark.createDataFrame([(False, None, None, None)], "incremental boolean, file string, pos bigint, row_no int")
    key = frame.select(S.order_key()).first()[0]
    assert tuple(key) == (False, -1, -1, 0)
    assert frame.select(S.lowest_order() < S.order_key()).first()[0]
