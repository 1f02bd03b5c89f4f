import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from lakesync import session
from lakesync.functions.types import ColumnSpec
from lakesync.operators import decode, reshard, routes as R
from lakesync.sources import catalog
from tests.helpers import doc, docs, rows

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

DETAILS = {
    "ledger_s00p00": {
        "type": 2,
        "sharding": {
            "sourceDb": "ledger_s([0-9]{2})p([0-9]{2})",
            "targetDb": "ledger_all",
            "tables": {
                "entries": {"sourceTable": "entries_[0-9]", "shardingType": "TEN"},
                "photos": {"sourceTable": "photos_[0-9]", "shardingType": "TEN", "nodata": True},
                "renamed": {"sourceTable": "legacy", "sharding": False, "batchSize": 7},
            },
        },
    },
    "member_s00p00": {"type": 2, "sharding": {"sourceDb": "member_s([0-9]{2})p([0-9]{2})", "targetDb": "u2",
                                                 "tables": {"profile": "profile_[0-9]"}}},
    "member_s00": {"type": 2, "sharding": {"sourceDb": "member_s([0-9]{2})", "targetDb": "u1",
                                              "tables": {"profile": "profile_[0-9]"}}},
    "books": {"type": 2, "sharding": {"dbNameSource": "books", "dbNameTarget": "acc",
                                           "tables": {"pages": "page_(1?[0-9]{1,2})"}},
                   "tables": ["kind"]},
    "plain": {"type": 2, "tables": ["a", "b"]},
    "all": {"type": 1},
    "except": {"type": 3, "tables": ["a"]},
    "nolist2": {"type": 2},
    "nolist3": {"type": 3},
    "strange": {"type": 9, "tables": ["a"]},
}


def resolved(spark, tables, details=None):
    cat = spark.createDataFrame([("i0", d, t) for d, t in tables], "instance string, db string, table string")
    return R.resolve_routes(cat, R.rules_from_config("i0", details or DETAILS))


def targets(spark, tables):
    return {(r.src_db, r.src_table): (r.dst_db, r.dst_table, r.sharding) for r in resolved(spark, tables).collect()}


def test_patterns_and_lists(spark):
    got = targets(
        spark,
        [
            ("ledger_s03p17", "entries_4"), ("ledger_s03p17", "entries_44"),
            ("ledger_s03p17", "legacy"), ("member_s01p02", "profile_1"), ("member_s01", "profile_1"),
            ("books", "page_199"), ("books", "page_200"), ("books", "kind"),
            ("xbooks", "kind"),
        ],
    )
    assert got == {
        ("ledger_s03p17", "entries_4"): ("ledger_all", "entries", True),
        ("ledger_s03p17", "legacy"): ("ledger_all", "renamed", False),
        ("member_s01p02", "profile_1"): ("u2", "profile", True),
        ("member_s01", "profile_1"): ("u1", "profile", True),
        ("books", "page_199"): ("acc", "pages", True),
        ("books", "kind"): ("acc", "kind", False),
    }


def test_sync_types(spark):
    tables = [(d, t) for d in ("plain", "all", "except", "nolist2", "nolist3", "strange") for t in ("a", "b", "c")]
    kept = {}
    for db, table in targets(spark, tables):
        kept.setdefault(db, set()).add(table)
    assert kept == {"plain": {"a", "b"}, "all": {"a", "b", "c"}, "except": {"b", "c"}}


def test_route_details(spark):
    got = {r.src_table: r for r in resolved(spark, [("ledger_s00p00", t) for t in ("entries_1", "photos_1", "legacy")]).collect()}
    assert (got["entries_1"].shard_count, got["entries_1"].shard_field, got["entries_1"].batch_size) == (10, "Fuid", 1024)
    assert got["legacy"].batch_size == 7 and got["legacy"].shard_field is None
    routes = resolved(spark, [("ledger_s00p00", "entries_1"), ("ledger_s00p00", "photos_1")])
    assert rows(R.data_routes(routes), "src_table") == [("entries_1",)]


def test_first_rule_wins_and_blank_target_is_the_source(spark):
    rules = [R.DatabaseRule("i0", "x", pattern="s_.*", sync_type=R.ALL), R.DatabaseRule("i0", "s_1", target="no", sync_type=R.ALL)]
    cat = spark.createDataFrame([("i0", "s_1", "t"), ("i9", "s_1", "t")], "instance string, db string, table string")
    assert rows(R.resolve_databases(cat, rules)) == [("i0", "s_1", "s_1")]
    assert rows(R.resolve_routes(cat, rules), "instance", "dst_db", "dst_table") == [("i0", "s_1", "t")]


def test_duplicate_routes_fail(spark):
    routes = resolved(spark, [("all", "a"), ("all", "a")])
    with pytest.raises(ValueError, match="i0.all.a"):
        R.check_routes(routes)
    R.check_routes(resolved(spark, [("all", "a"), ("all", "b")]))


def test_routing_keeps_unrouted_rows(spark):
    changes = decode.decode(docs(spark, [doc("c", {"id": 1}, db="all", table="a"), doc("c", {"id": 2}, db="zz", table="a")]))
    for check in (True, False):
        got = rows(R.route(changes, resolved(spark, [("all", "a")]), check), "db", "dst_db", "_reason")
        assert got == [("all", "all", None), ("zz", None, "unrouted")]


def test_broadcast_only_below_the_bound(spark):
    # Size statistics must not broadcast by themselves here.
    small, large = spark.range(10), spark.range(11)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for side, expected in ((small, True), (large, False)):
            joined = spark.range(100).join(session.bounded_broadcast(side, 10), "id")
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert ("BroadcastHashJoin" in plan) is expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def tesrenamed_routes(spark):
    routes = resolved(spark, [("all", "a"), ("all", "b")])
    assert rows(R.new_routes(routes, routes.where("src_table = 'a'")), "src_table") == [("b",)]


def test_column_meta_and_keys(spark):
    columns = spark.createDataFrame(
        [
            ("d", "t", "id", 1, "bigint(20) unsigned", None, "the key", "auto_increment"),
            ("d", "t", "x", 2, "varchar(9)", "9", "", ""),
            ("d", "u", "b", 2, "int", None, "", ""),
            ("d", "u", "a", 1, "int", None, "", ""),
            ("d", "n", "a", 1, "int", None, "", ""),
            ("mysql", "user", "a", 1, "int", None, "", ""),
        ],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, ORDINAL_POSITION int, COLUMN_TYPE string, "
        "CHARACTER_MAXIMUM_LENGTH string, COLUMN_COMMENT string, EXTRA string",
    )
    statistics = spark.createDataFrame(
        [("d", "t", "id", 0, "PRIMARY"), ("d", "t", "x", 0, "u"), ("d", "u", "b", 0, "u1"), ("d", "u", "a", 0, "u2"),
         ("d", "n", "a", 1, "i")],
        "TABLE_SCHEMA string, TABLE_NAME string, COLUMN_NAME string, NON_UNIQUE int, INDEX_NAME string",
    )
    meta = catalog.column_meta(columns, statistics)
    assert rows(catalog.table_keys(meta), "table", "pk", "keys", "autoincrement") == [
        ("n", [], [], False), ("t", ["id"], ["id"], True), ("u", [], ["a", "b"], False),
    ]
    first = meta.where("name = 'id'").first()
    assert (first.type_name, first.comment, first.length) == ("BIGINT(20) UNSIGNED", "the key", None)
    routes = resolved(spark, [("all", "t")]).withColumn("src_db", F.lit("d"))
    assert catalog.with_keys(routes, meta).first()["keys"] == ["id"]
    assert rows(catalog.tables(meta, "i0"), "table") == [("n",), ("t",), ("u",)]


def test_reshard_marks_bad_keys(spark):
    frame = spark.createDataFrame([(1, 13), (2, -1), (3, None)], "id int, Fuid bigint")
    assert rows(reshard.with_shard(frame, "Fuid", "TEN"), "id", "shard", "_reason") == [
        (1, 3, None), (2, None, "bad_shard_key"), (3, None, "bad_shard_key"),
    ]
    assert rows(reshard.with_shard(frame, "Fuid", "ONE"), "shard") == [(0,)] * 3
    with pytest.raises(ValueError):
        reshard.with_shard(frame, "id", "TEN")


def test_shard_field_check_and_names():
    columns = [ColumnSpec("Fuid", "BIGINT")]
    reshard.check_shard_field(columns, None, "TEN")
    reshard.check_shard_field([], "x", "ONE")
    for field in ("Frc_order_id", "other"):
        with pytest.raises(ValueError):
            reshard.check_shard_field(columns, field, "TEN")
    assert reshard.shard_tables("t", "TEN")[-1] == "t_9" and reshard.shard_tables("t", None) == ["t"]


def test_merge_key_widening():
    auto = [ColumnSpec("id", "INT", is_pk=True, is_autoincrement=True), ColumnSpec("v")]
    wide = reshard.widened_for_merge(auto, True)
    assert [(c.name, c.is_pk) for c in wide] == [("id", True), ("db_index", True), ("table_index", True), ("v", False)]
    assert reshard.has_merge_indexes(wide) and not reshard.has_merge_indexes(auto)
    assert reshard.widened_for_merge(auto, False) == auto
    plain = [ColumnSpec("id", "INT", is_pk=True)]
    assert reshard.widened_for_merge(plain, True) == plain


def test_merge_indexes_need_digits(spark):
    frame = spark.createDataFrame([("a_00_07_db", "t_3"), ("x", "t_3")], "db string, table string")
    assert rows(reshard.with_merge_indexes(frame), "db_index", "table_index", "_reason") == [
        ("00_07", "3", None), (None, "3", "no_shard_index"),
    ]
    assert reshard.with_lineage(frame).columns == ["db_name", "table_name"]


FRESH = """
import sys
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
    .config("spark.checkpoint.dir", sys.argv[1] + "/shared").config("spark.sql.warehouse.dir", sys.argv[1] + "/warehouse").getOrCreate())
from lakesync.operators.routes import resolve_routes
from lakesync.sources import catalog
from queries import feed
tables = feed.shop_catalog(spark, sys.argv[2])
keyed = catalog.with_keys(resolve_routes(tables, feed.SHOP_RULES), feed.shop_meta(tables.drop("instance")))
assert {tuple(r["keys"]) for r in keyed.collect()} == {("id",)}
"""


def test_keys_of_the_same_catalog_in_a_fresh_session(sf_dir, tmp_path):
    """What the first query of a session infers of the rules once named a column that the keys do not have."""
    done = subprocess.run([sys.executable, "-c", FRESH, str(tmp_path), sf_dir], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-2000:]
