import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakesync.functions import naming, shards, wire
from lakesync.functions.types import ColumnSpec, bare_type, ddl_type, spark_type, specs_from_rows, with_wire
from lakesync.functions import types as T


def values(spark, kind, items, column):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}")
    return [r[0] for r in frame.orderBy("i").select(column(F.col("x")), "i").collect()]


def test_type_lookup_ignores_case_and_length():
    assert bare_type("int(11) unsigned zerofill") == "INT UNSIGNED"
    assert spark_type("decimal(10,2)") == "decimal(38,20)"
    assert spark_type("json") == "string"
    assert spark_type("Bigint Unsigned", widen_unsigned=True) == "decimal(20,0)"
    assert spark_type("int unsigned") == "int"


def test_ddl_type_column(spark):
    assert values(spark, "string", ["bigint", "DECIMAL", "enum", "datetime"], ddl_type) == [
        "long", "decimal(38, 20)", "string", "timestamp",
    ]


def test_specs_from_rows_keep_column_order():
    row = dict(type_name="INT", is_pk=False, is_uk=False, comment=None, length=None, is_autoincrement=False)
    specs = specs_from_rows([dict(row, name="b", ordinal=2), dict(row, name="a", ordinal=1)])
    assert [s.name for s in specs] == ["a", "b"]
    assert with_wire(specs, {"a": T.MICRO_TIME})[0].wire == T.MICRO_TIME


@pytest.mark.parametrize(
    "text, offset",
    [("+07:00", "+07:00"), ("GMT+7", "+07:00"), ("GMT-03:30", "-03:30"), ("utc", "+00:00"), ("Asia/Jakarta", "Asia/Jakarta")],
)
def test_zone(text, offset):
    assert wire.zone(text) == offset


@pytest.mark.parametrize("text", ["", "nowhere", "GMT+99", "+7:0:0"])
def test_unknown_zone(text):
    with pytest.raises(ValueError):
        wire.zone(text)


def test_zone_shift():
    assert wire.zone_shift("GMT+8", "+07:00") == -3_600_000


def test_clocks(spark):
    assert values(spark, "bigint", [0, 19000, -1, None], wire.date_from_days) == [
        dt.date(1970, 1, 1), dt.date(2022, 1, 8), dt.date(1969, 12, 31), None,
    ]
    assert values(spark, "bigint", [0, -1, 2**62], wire.ntz_from_micros) == [
        dt.datetime(1970, 1, 1), dt.datetime(1969, 12, 31, 23, 59, 59, 999999), None,
    ]
    assert values(spark, "bigint", [-1500, 1999], wire.ntz_from_nanos) == [
        dt.datetime(1969, 12, 31, 23, 59, 59, 999998), dt.datetime(1970, 1, 1, 0, 0, 0, 1),
    ]
    assert values(spark, "bigint", [0, 36_672_500_000, wire.DAY_MICROS, -1], lambda c: wire.time_from_micros(c).cast("string")) == [
        "00:00:00", "10:11:12.5", None, None,
    ]
    assert values(spark, "bigint", [36_672_500_000_123], lambda c: wire.time_from_nanos(c).cast("string")) == ["10:11:12.5"]


def test_shift_spares_the_epoch(spark):
    hour = 3_600_000
    assert values(spark, "bigint", [0, 1, 1_700_000_000_123], lambda c: wire.shifted_millis(c, hour)) == [
        0, hour + 1, 1_700_003_600_123,
    ]
    assert values(spark, "bigint", [0, 1_700_000_000_123], lambda c: wire.shifted_text(c, -hour)) == [
        "1970-01-01 00:00:00", "2023-11-14 21:13:20",
    ]
    assert values(spark, "bigint", [5], lambda c: wire.shifted_millis(c, 0)) == [5]


def test_zoned_text(spark):
    items = ["2024-01-01T00:00:00Z", "2024-01-01T00:00:00.123Z", "0000-00-00 00:00:00", "nonsense", None]
    assert values(spark, "string", items, lambda c: wire.zoned_text(c, "GMT+7")) == [
        "2024-01-01 07:00:00", "2024-01-01 07:00:00.123", None, None, None,
    ]
    assert values(spark, "string", items[:1], lambda c: wire.zoned_iso_text(c, "+08:00")) == ["2024-01-01T08:00:00"]
    assert values(spark, "string", ["1704067200000"], lambda c: wire.zoned_text(c, "+07:00")) == ["2024-01-01 07:00:00"]


def test_base64_decimal(spark):
    def encoded(n, size):
        import base64

        return base64.b64encode(n.to_bytes(size, "big", signed=True)).decode()

    numbers = [(12345, 2), (-12345, 2), (-1, 1), (0, 1), (127, 1), (-128, 1), (2**63, 9), (-(2**100), 13), (10**22, 16)]
    items = [encoded(n, size) for n, size in numbers]
    got = values(spark, "string", items, lambda c: wire.decimal_from_base64(c, 5))
    whole = [Decimal(n).scaleb(-5) for n, _ in numbers]
    # decimal(38,20) holds 18 integer digits; beyond that there is no value.
    assert got == [x if abs(x) < 10**18 else None for x in whole]
    assert values(spark, "string", ["", "***"], lambda c: wire.decimal_from_base64(c, 0)) == [None, None]


def test_shard_indexes(spark):
    names = ["a_00_07_db", "db7x", "nodigit"]
    assert values(spark, "string", names, shards.database_index) == ["00_07", "7", None]
    assert values(spark, "string", ["t_card_7", "t2_card_3", "nodigit"], shards.table_index) == ["7", "2_card_3", None]


@pytest.mark.parametrize("count", [1, 10, 100, 1000])
def test_shard_of_uid(spark, count):
    items = [0, 9, 10, 1234, 2**31 + 7, None, -7]
    expected = [x % count if x is not None and x >= 0 else None for x in items]
    assert values(spark, "bigint", items, lambda c: shards.shard_of_uid(c, count)) == expected


def test_shard_of_order(spark):
    items = ["ORD0123987", "12", "x-98", "AB98x", None]
    for count, first in ((10, 7), (100, 87), (1000, 987)):
        assert values(spark, "string", items, lambda c: shards.shard_of_order(c, count)) == [first, None, None, None, None]


def test_shard_count_names():
    assert shards.shard_count("TEN") == 10 and shards.shard_count(None) == 1 and shards.shard_count(1000) == 1000
    with pytest.raises(ValueError):
        shards.shard_count(7)


def test_names(spark):
    row = spark.range(1).select(
        naming.topic("PROD", F.lit("d"), F.lit("t")), naming.topic("TEST", F.lit("d"), F.lit("t")),
        naming.ods_namespace("TEST", F.lit("d")),
    ).first()
    assert tuple(row) == ("flink.d.t", "flink.test.d.t", "test_ods_d")
    assert naming.dwd_namespace_name("PROD") == "dwd" and naming.ods_namespace_name("PROD", "x") == "ods_x"
    with pytest.raises(ValueError):
        naming.dwd_namespace_name("")


def test_containers(spark):
    row = F.parse_json(
        F.lit('{"a":[1,2],"m":{"x":"1"},"p":[[1,"u"],[2,"v"]],"s":{"k":3},"b":"aGk=","n":null,"q\'":5}')
    )
    got = spark.range(1).select(
        wire.array_field(row, "a", "int"), wire.map_field(row, "m", "string"),
        wire.keyed_pairs_field(row, "p", "int", "string"), wire.struct_field(row, "s", "k: int"),
        wire.typed_field(row, ColumnSpec("b", "BLOB")), wire.present(row, "n"), wire.present(row, "zz"),
        wire.typed_field(row, ColumnSpec("q'", "INT")),
    ).first()
    assert got[0] == [1, 2] and got[1] == {"x": "1"} and got[2] == {1: "u", 2: "v"} and got[3].k == 3
    assert bytes(got[4]) == b"hi" and got[5] is False and got[6] is False and got[7] == 5
