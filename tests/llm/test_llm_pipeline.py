import os
import sys

sys.path.insert(0, os.path.dirname(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(__file__))))

import corpus_pipeline as C  # noqa: E402
from helpers_llm import SCHEMA, clashing, words  # noqa: E402
from test_llm_decontaminate import brute as passages  # noqa: E402
from test_llm_jaccard import brute as components  # noqa: E402
from test_llm_secrets import brute as secrets  # noqa: E402

import __spark_entry__ as contract  # noqa: E402
from lakesync.llm.secrets import cleaned  # noqa: E402


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()}
    text = {r.doc_id: r.text for r in docs.collect()}
    frame, want = docs, dict(text)
    for name, stage in C.STAGES:
        frame = stage(spark, frame, sf_dir)
        if name == "language":
            got = {r.doc_id: r.text for r in frame.collect()}
            # All of these texts are in a language, with few junk ones: hardly any goes, none changes.
            assert len(got) >= 0.98 * len(want) and all(want[i] == t for i, t in got.items())
            want = got
        elif name == "near_duplicates":
            want = {i: want[i] for i, _, c in components(list(want.items())) if i == c}
        elif name == "benchmark":
            dirty = {i for i, _ in passages(want, items)}
            assert dirty
            want = {i: t for i, t in want.items() if i not in dirty}
        elif name == "secrets":
            want = {i: cleaned(t, secrets(t)) for i, t in want.items()}
            assert any("<secret>" in t for t in want.values())
        if name == "mix":
            got = frame.collect()
            assert {(r.doc_id, r.size) for r in got} == {(i, len(words(t))) for i, t in want.items()}
            assert abs(sum(r.taken for r in got) - sum(r.size for r in got)) <= 0.01 * sum(r.size for r in got)
        else:
            assert frame.columns == docs.columns
            assert {r.doc_id: r.text for r in frame.collect()} == want
            assert all(r.n_chars == len(r.text) for r in frame.collect())


def test_run_is_registered(spark, sf_dir):
    queries = contract.queries()
    assert "pipeline" in queries and {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in queries}
    assert set(contract.oracle_sql()) <= set(queries)
    assert queries["pipeline"](spark, sf_dir).count() > 0


def test_nulls_ties_empty_tables_and_clashing_names(spark, sf_dir):
    rows = [(i, f"the house and the tree are number {i} of them all and so on {i * 7}", "en", "a", 1) for i in range(12)]
    rows += [(20, None, None, None, None), (21, "", "en", "a", 0), (22, "?! 12", "en", None, 5), (3, rows[3][1], "en", "a", 1), (None, "no id at all here", "en", "a", 3)]
    rows += [(30, "a token=abcdefghijklmnopqr here", None, "b", None), (31, "word " * 100_000, "en", "b", 1)]
    names = ["row", "score", "lang_pred", "at", "told", "goes", "place", "cleaned", "spans", "rep", "n", "block", "target", "taken", "a", "b"]
    docs = clashing(spark.createDataFrame(rows, SCHEMA), names)
    frame = docs
    for name, stage in C.STAGES:
        before = frame.columns
        frame = stage(spark, frame, sf_dir)
        assert name == "mix" or frame.columns == before == docs.columns
    left = sorted((r.doc_id for r in frame.collect()), key=str)
    assert 20 not in left and 21 not in left and 22 not in left and left.count(3) <= 1 and {30, 31, None} <= set(left)
    empty = spark.createDataFrame([], SCHEMA)
    for _, stage in C.STAGES:
        empty = stage(spark, empty, sf_dir)
        assert empty.count() == 0
