import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import types as T
from lakesync.functions.types import ColumnSpec
from lakesync.operators import decode, quality
from lakesync.operators.typed import rejected, typed_rows
from lakesync.plans import sync
from lakesync.sources import envelopes, snapshot
from tests.helpers import COLUMNS, ddl_doc, doc, docs, rows


def typed(spark, row, columns, **options):
    d = decode.decode(docs(spark, [doc("c", row)]))
    return typed_rows(d, columns, **options).first()


def test_operation_codes_and_images(spark):
    lines = [
        doc("r", {"id": 1}, ts_ms=0), doc("c", {"id": 2}), doc("u", {"id": 3}, before={"id": 3, "v": "old"}),
        doc("d", {"id": 4}), ddl_doc("ALTER TABLE t DROP x"),
    ]
    d = decode.decode(docs(spark, lines))
    got = rows(d, "op", F.to_json("row"), "incremental", "ddl")
    assert got == [
        (0, '{"id":1}', False, None), (0, '{"id":2}', True, None), (2, '{"id":3}', True, None),
        (3, '{"id":4}', True, None), (4, None, False, "ALTER TABLE t DROP x"),
    ]


def test_malformed_and_imageless_documents(spark):
    lines = ['{"op":"u","after":{', "", doc("u", None), doc("d", None)]
    got = [r[0] for r in decode.decode(docs(spark, lines)).select("_reason").collect()]
    assert got == ["malformed", "malformed", "no_image", "no_image"]


def test_offset_text_fills_the_position(spark):
    line = json.dumps({"source": {"db": "a", "table": "t", "ts_ms": 5}, "historyRecord": '{"ddl":"x"}',
                       "offset": '{"file":"bin.000009","pos":77,"extra":1}'})
    assert rows(decode.decode(docs(spark, [line])), "file", "pos", "ddl") == [("bin.000009", 77, "x")]


def test_stored_op_codes(spark):
    frame = spark.createDataFrame([(0, None), (1, None), (9, None), (None, None), (9, "x")], "op int, _reason string")
    assert [r[1] for r in decode.bad_op(frame).collect()] == [None, None, "bad_op", "bad_op", "bad_op"]


def test_key_change_becomes_delete_and_insert(spark):
    lines = [
        doc("u", {"id": 2, "v": "b"}, before={"id": 1, "v": "a"}),
        doc("u", {"id": 5, "v": "d"}, before={"id": 5, "v": "c"}),
        doc("u", {"id": 6, "v": "d"}, before={"v": "c"}),
        doc("u", {"id": 7, "v": "d"}),
    ]
    out = decode.split_key_updates(decode.decode(docs(spark, lines)), sync.variant_key(["id"]))
    got = rows(out, "op", F.to_json("row"))
    assert got == [
        (0, '{"id":2,"v":"b"}'), (2, '{"id":5,"v":"d"}'), (2, '{"id":6,"v":"d"}'), (2, '{"id":7,"v":"d"}'),
        (3, '{"id":1,"v":"a"}'),
    ]


def test_exact_decimals(spark):
    # One digit too many before the point: no value fits, so the row goes aside.
    line = doc("c", {"id": 1, "a": "@"}).replace('"@"', "123456789012345678.12345678901234567890")
    wide = doc("c", {"id": 2, "a": "@"}).replace('"@"', "1234567890123456789")
    columns = [ColumnSpec("id", "BIGINT", is_pk=True), ColumnSpec("a", "DECIMAL(40,20)")]
    got = rows(typed_rows(decode.decode(docs(spark, [line, wide])), columns), "id", "a", "_reason")
    assert got == [(1, Decimal("123456789012345678.12345678901234567890"), None), (2, None, "bad_cast")]


@pytest.mark.parametrize("widen, reason", [(False, "bad_cast"), (True, None)])
def test_unsigned_overflow(spark, widen, reason):
    line = doc("c", {"id": 1, "u": 2**31, "b": "@"}).replace('"@"', str(2**64 - 1))
    columns = [ColumnSpec("id", "INT", is_pk=True), ColumnSpec("u", "int unsigned"), ColumnSpec("b", "bigint unsigned")]
    got = typed_rows(decode.decode(docs(spark, [line])), columns, widen_unsigned=widen).first()
    assert got["_reason"] == reason
    if widen:
        assert (got["u"], got["b"]) == (2**31, Decimal(2**64 - 1))


def test_nulls_defaults_and_keys(spark):
    columns = [
        ColumnSpec("id", "INT", is_pk=True), ColumnSpec("a", "INT"), ColumnSpec("b", "VARCHAR", default="dflt"),
        ColumnSpec("c", "VARCHAR", required=True),
    ]
    assert tuple(typed(spark, {"id": 1, "a": None, "c": "x"}, columns)) == (1, None, "dflt", "x", None)
    assert typed(spark, {"id": 1}, columns)["_reason"] == "missing_key"
    assert typed(spark, {"c": "x"}, columns)["_reason"] == "missing_key"
    assert typed(spark, {"id": "one", "c": "x"}, columns)["_reason"] == "bad_cast"


def test_zero_dates_are_null(spark):
    columns = [ColumnSpec("id", "INT", is_pk=True), ColumnSpec("d", "DATE"), ColumnSpec("t", "DATETIME"), ColumnSpec("z", "TIMESTAMP")]
    row = {"id": 1, "d": "0000-00-00", "t": "0000-00-00 00:00:00", "z": "0000-00-00 00:00:00"}
    assert tuple(typed(spark, row, columns)) == (1, None, None, None, None)
    assert typed(spark, dict(row, t="yesterday"), columns)["_reason"] == "bad_cast"
    assert typed(spark, dict(row, t="2024-01-02 03:04:05"), columns)["t"].hour == 3


def test_bit_accepts_flags_and_numbers(spark):
    columns = [ColumnSpec("id", "INT", is_pk=True), ColumnSpec("b", "BIT")]
    assert [typed(spark, {"id": 1, "b": x}, columns)["b"] for x in (True, False, 1)] == [1, 0, 1]


def test_lineage_indexes_and_sync_time(spark):
    got = typed(spark, {"id": 1, "v": "x"}, COLUMNS, lineage=True, merge_indexes=True, f_ts=9)
    assert got.asDict() == {
        "db_name": "shop_01_db", "table_name": "t_event_3", "id": 1, "v": "x", "db_index": "01", "table_index": "3",
        "f_ts": 9, "_reason": None,
    }


def test_wire_override(spark):
    columns = [ColumnSpec("id", "INT", is_pk=True), ColumnSpec("t", "TIME", wire=T.NANO_TIME)]
    spark_time = typed_rows(decode.decode(docs(spark, [doc("c", {"id": 1, "t": 1_000_000_999})])), columns)
    assert spark_time.select(F.col("t").cast("string")).first()[0] == "00:00:01"


def test_start_positions(spark):
    lines = [
        doc("r", {"id": 1}, ts_ms=0, pos=1), doc("c", {"id": 2}, ts_ms=10, file="bin.999999", pos=5),
        doc("c", {"id": 3}, ts_ms=20, file="bin.1000000", pos=1),
    ]
    d = decode.decode(docs(spark, lines))
    key = F.try_variant_get("row", "$.id", "int")

    def ids(**start):
        return [r[0] for r in rows(envelopes.start_from(d, **start), key)]

    assert ids() == [1, 2, 3]
    assert ids(mode=envelopes.EARLIEST) == [2, 3]
    assert ids(ts_ms=20) == [3]
    assert ids(mode=envelopes.LATEST, end=("bin.999999", 5)) == [3]
    with pytest.raises(ValueError):
        ids(mode="SPECIFIC")
    with pytest.raises(ValueError):
        ids(mode=envelopes.LATEST)


def test_topic_start():
    assert envelopes.topic_start(None, 5) == {"startingTimestamp": "5"}
    assert envelopes.topic_start("LATEST_OFFSET") == {"startingOffsets": "latest"}


def test_snapshot_options():
    options = snapshot.jdbc_options("jdbc:x", "t", column="id", bounds=(0, 100), partitions=8, user="u", password="p")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["fetchsize"] == "1024"


def test_snapshot_rows_sort_below_the_log(spark):
    table = spark.createDataFrame([(1, "snap")], "id bigint, v string")
    snap = snapshot.snapshot(table, "i0", "a", "t", file="bin.000009", pos=100)
    log = decode.decode(docs(spark, [doc("u", {"id": 1, "v": "log"}, db="a", table="t", file="bin.000009", pos=101),
                                     doc("u", {"id": 1, "v": "old"}, db="a", table="t", file="bin.000009", pos=99)]))
    both = envelopes.snapshot_then_log(snap, log, ("bin.000009", 100))
    assert both.count() == 2
    assert both.select(F.max_by(F.to_json("row"), S.order_key())).first()[0] == '{"id":1,"v":"log"}'


def test_quarantine_keeps_every_row(spark):
    lines = [doc("c", {"id": 1}), "broken", doc("d", None)]
    d = decode.decode(docs(spark, lines))
    assert quality.accepted(d).count() + quality.quarantined(d).count() == 3
    assert quality.quarantined(d).columns[0] == "reason"
    assert rows(quality.quarantined(d), "reason", "document") == [("malformed", "broken"), ("no_image", None)]


def test_rejected_rows_stay_whole(spark):
    d = decode.decode(docs(spark, [doc("c", {"id": 1, "v": 2}), doc("c", {"id": "x", "v": 3}, pos=9), "broken"]))
    bad = rejected(d.where("op <> 4"), [ColumnSpec("id", "INT", is_pk=True)])
    assert rows(bad, "reason", "pos", F.to_json("row")) == [("bad_cast", 9, '{"id":"x","v":3}')]
