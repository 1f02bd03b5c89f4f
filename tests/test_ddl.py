import pytest
from pyspark.sql import functions as F

from lakesync.functions.types import ColumnSpec
from lakesync.operators import ddl, decode
from lakesync.operators.routes import route
from tests.helpers import ddl_doc, doc, docs, rows


def actions(spark, text):
    frame = spark.createDataFrame([(text,)], "ddl string")
    got = ddl.actions(frame).orderBy("seq").collect()
    return [(r.action, r.column_name, r.new_name, r.type_name, None if r.action == "SKIP" else r.comment, r.first, r.after_col) for r in got]


def target(spark, text):
    frame = spark.createDataFrame([(text,)], "ddl string")
    return frame.select(ddl.target_ddl(F.col("ddl"), F.lit("d"), F.lit("t"))).first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("ALTER TABLE t ADD a INT", [("ADD", "a", None, "INT", None, False, None)]),
        ("alter table `d`.`t` add column `a` decimal(10,2) first", [("ADD", "a", None, "DECIMAL", None, True, None)]),
        (
            "ALTER TABLE t ADD a INT COMMENT 'x, (y' AFTER `b`, DROP COLUMN c",
            [("ADD", "a", None, "INT", "x, (y", False, "b"), ("DROP", "c", None, None, None, False, None)],
        ),
        (
            "ALTER TABLE t ADD COLUMN (a INT, b ENUM('p','q') COMMENT \"it's\")",
            [("ADD", "a", None, "INT", None, False, None), ("ADD", "b", None, "ENUM", "it's", False, None)],
        ),
        ("ALTER TABLE t CHANGE a `b c` BIGINT unsigned AFTER z;", [("CHANGE", "a", "b c", "BIGINT UNSIGNED", None, False, "z")]),
        ("ALTER TABLE t DROP a, b", [("DROP", "a", None, None, None, False, None), ("DROP", "b", None, None, None, False, None)]),
        ("ALTER TABLE t ADD first_name INT DEFAULT 1", [("ADD", "first_name", None, "INT", None, False, None)]),
    ],
)
def test_actions(spark, text, expected):
    assert actions(spark, text) == expected


@pytest.mark.parametrize(
    "text",
    [
        "CREATE INDEX i ON t (a)", "ALTER TABLE t ADD UNIQUE KEY u (a, b)",
        "ALTER TABLE t DROP INDEX i", "DROP TABLE t", "ALTER TABLE t ADD CONSTRAINT c FOREIGN KEY (a) REFERENCES x (y)",
        "TRUNCATE t",
    ],
)
def test_other_items_are_skipped(spark, text):
    assert {a[0] for a in actions(spark, text)} == {"SKIP"}
    assert target(spark, text) == ""


def test_several_statements(spark):
    text = "ALTER TABLE t ADD a INT COMMENT 'x;y'; ALTER TABLE t DROP b;"
    assert [a[:2] for a in actions(spark, text)] == [("ADD", "a"), ("DROP", "b")]


def test_target_statements(spark):
    text = "ALTER TABLE s ADD a BIGINT, CHANGE b c DATETIME COMMENT 'n' FIRST, ADD a BIGINT, DROP `e`"
    assert target(spark, text).split(";\n") == [
        "alter table d.t add columns (a long comment '')",
        "alter table d.t rename column b to c",
        "alter table d.t alter column c first",
        "alter table d.t alter column c comment 'n'",
        "alter table d.t drop column e",
    ]


def log_of(spark, texts):
    data = [("i0", "d", "t", x, "bin.000001", 10 * n, n) for n, x in enumerate(texts)]
    return spark.createDataFrame(data, "instance string, dst_db string, dst_table string, ddl string, file string, pos bigint, ts_ms bigint")


BASE = [ColumnSpec("id", "BIGINT", is_pk=True), ColumnSpec("a", "INT"), ColumnSpec("b", "VARCHAR")]


def evolved(spark, *texts):
    return ddl.evolve_from_log(BASE, log_of(spark, texts), "d", "t")


def test_evolution_steps(spark):
    assert evolved(spark, "ALTER TABLE t ADD c DATE AFTER id").names() == ["id", "c", "a", "b"]
    assert evolved(spark, "ALTER TABLE t ADD a DATE").changed is False
    assert evolved(spark, "ALTER TABLE t CHANGE a x BIGINT, ADD y INT AFTER x").names() == ["id", "x", "y", "b"]
    assert evolved(spark, "ALTER TABLE t CHANGE a b2 INT FIRST", "ALTER TABLE t DROP b").names() == ["b2", "id"]
    wider = evolved(spark, "ALTER TABLE t MODIFY COLUMN a BIGINT COMMENT 'n' AFTER b")
    assert wider.names() == ["id", "b", "a"] and (wider.columns[2].type_name, wider.columns[2].comment) == ("BIGINT", "n")
    renamed = evolved(spark, "ALTER TABLE t RENAME COLUMN a TO `x`")
    assert renamed.names() == ["id", "x", "b"] and renamed.columns[1].type_name == "INT"
    assert evolved(spark, "ALTER TABLE t RENAME INDEX a TO x, RENAME TO u, MODIFY gone INT").changed is False
    assert evolved(spark, "ALTER TABLE t CHANGE a a BIGINT COMMENT 'n'").columns[1].comment == "n"
    assert evolved(spark).names() == ["id", "a", "b"]


def test_evolved_table_and_comments(spark):
    table = spark.createDataFrame([(1, 7, "x")], "id bigint, a int, b string")
    e = evolved(spark, "ALTER TABLE t CHANGE a x BIGINT COMMENT 'num' FIRST, DROP b, ADD c DATE")
    out = ddl.evolved_table(table, e)
    assert out.columns == ["x", "id", "c"] and tuple(out.first()) == (7, 1, None)
    assert out.schema["x"].dataType.simpleString() == "bigint" and out.schema["x"].metadata["comment"] == "num"


def test_dropped_and_added_again_starts_empty(spark):
    table = spark.createDataFrame([(1, 7, "x")], "id bigint, a int, b string")
    e = evolved(spark, "ALTER TABLE t DROP b", "ALTER TABLE t ADD b VARCHAR(9)")
    assert tuple(ddl.evolved_table(table, e).first()) == (1, 7, None)
    changes = decode.decode(docs(spark, [doc("c", {"id": 1, "b": "old"}, pos=5), doc("c", {"id": 2, "b": "new"}, pos=15)]))
    assert rows(ddl.evolved_rows(changes, e), "id", "b") == [(1, None), (2, "new")]


def test_rows_around_a_rename(spark):
    e = evolved(spark, "SELECT 1", "ALTER TABLE t CHANGE a x BIGINT")
    lines = [doc("c", {"id": 1, "a": 5}, pos=9), doc("c", {"id": 2, "x": 6, "a": 0}, pos=11), doc("r", {"id": 3, "a": 4}, file="", pos=0, ts_ms=0)]
    assert rows(ddl.evolved_rows(decode.decode(docs(spark, lines)), e), "id", "x") == [(1, 5), (2, 6), (3, 4)]
    wrong = decode.decode(docs(spark, [doc("c", {"id": 1, "x": "six"}, pos=11), doc("c", {"id": 2, "x": "six"}, pos=9)]))
    assert rows(ddl.evolved_rows(wrong, e), "id", "x", "_reason") == [(1, None, "bad_cast"), (2, None, None)]


def test_status(spark):
    log = log_of(spark, ["ALTER TABLE t ADD c INT"])
    assert ddl.evolution_status(log, evolved(spark, "ALTER TABLE t ADD c INT")).first()["status"] == "applied"


def test_specs_of_existing_table(spark):
    schema = spark.createDataFrame([], "a int, b decimal(38,20), c string, d timestamp_ntz").schema
    assert [s.spark_type() for s in ddl.specs_of(schema)] == ["int", "decimal(38,20)", "string", "timestamp_ntz"]


def test_capture(spark):
    text = "ALTER TABLE t ADD a INT"
    lines = [
        ddl_doc(text, pos=5, ts_ms=10), ddl_doc(text, pos=5, ts_ms=11), ddl_doc(text, pos=5, ts_ms=12, instance="i1"),
        ddl_doc(text, file="  "), ddl_doc(text, db="zz"), doc("c", {"id": 1}),
    ]
    routes = spark.createDataFrame(
        [(i, "shop_01_db", "t_event_3", "d", "t") for i in ("i0", "i1")],
        "instance string, src_db string, src_table string, dst_db string, dst_table string",
    )
    log, blank = ddl.capture(route(decode.decode(docs(spark, lines)), routes))
    assert rows(log, "instance", "pos", "ts_ms", "dst_db") == [("i0", 5, 10, "d"), ("i1", 5, 12, "d")]
    assert rows(blank, "_reason") == [("blank_offset",)]
    ordered = ddl.in_log_order(log).collect()
    assert [r.ts_ms for r in ordered] == [10, 12]


def test_stream_dedupe(spark, tmp_path):
    data = [("i0", "f", 1), ("i0", "f", 1), ("i1", "f", 1)]
    spark.createDataFrame(data, "instance string, file string, pos bigint").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("instance string, file string, pos bigint").parquet(str(tmp_path / "in"))
    stamped = stream.withColumn("at", F.lit("2024-01-01").cast("timestamp"))
    out = ddl.dedupe_stream(stamped, "at", "1 hour")
    query = (
        out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
