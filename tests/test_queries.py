"""Every registered query against its oracle, and the shape of the plans."""

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as contract  # noqa: E402

duckdb = pytest.importorskip("duckdb")

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
QUERIES = {name: query for family in contract.CORE for name, query in family.QUERIES.items()}
ORACLE = {name: sql for family in contract.CORE for name, sql in family.ORACLE.items()}


def normal(names, data):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=repr), [names[i] for i in order]


@pytest.fixture(scope="module")
def oracle(sf_dir_module):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir_module}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def sf_dir_module():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, oracle, sf_dir_module, name):
    got = QUERIES[name](spark, sf_dir_module)
    want = oracle.sql(ORACLE[name])
    rows, names = normal(got.columns, [tuple(r) for r in got.collect()])
    expected, columns = normal(want.columns, want.fetchall())
    assert names == columns
    assert rows == expected
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # No window or aggregate may pull a whole table into one partition.
    assert not re.search(r"Exchange SinglePartition", plan), plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
