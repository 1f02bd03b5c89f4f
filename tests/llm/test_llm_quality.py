import os
import sys

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, SPACE, clashing, documents, words  # noqa: E402

from lakesync.llm import quality_rules  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def brute(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    twice = {g for g in grams if grams.count(g) > 1} if len(grams) < 500 else repeated(grams)
    covered = {i + k for i, g in enumerate(grams) if g in twice for k in range(3)}
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)),
        len(covered),
    )


def repeated(grams):
    seen, twice = set(), set()
    for g in grams:
        (twice if g in seen else seen).add(g)
    return twice


def test_counts_of_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = quality_rules.judged(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()
    assert len(got) == len(texts)
    for r in got:
        want = brute(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.kept and r.base_failed)


def test_edges(spark):
    texts = ["", None, "a", "a a a a", "é ü\n\n é ü\n \t\né ü", "x\x0by\x0cz\r\nx", "#*$%&|<> <", "a b c a b c a b", "    x"]
    texts += [" ".join(f"w{i % 3000}" for i in range(40_000))]
    docs = clashing(documents(spark, texts), ["w", "lines", "windows", "bins", "bad", "rule"])
    got = {r.doc_id: r for r in quality_rules.judged(docs, spark.createDataFrame([], LABELS)).collect()}
    for i, text in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute(text), text
        assert r.kept == (not r.base_failed)
    assert quality_rules.judged(spark.createDataFrame([], SCHEMA), spark.createDataFrame([], LABELS)).collect() == []


def test_learns_and_keeps_clean(spark):
    clean = [" ".join(f"word{(i * 37 + k) % 997}" for i in range(80 + k % 40)) for k in range(120)]
    shouting = [" ".join(f"WORD{(i * 41 + k) % 991}!!" for i in range(80 + k % 30)) for k in range(40)]
    docs = documents(spark, clean + shouting)
    labels = spark.createDataFrame([(i, int(i < 120), 0) for i in range(160)] + [(3, None, 0), (None, 1, 0)], LABELS)
    got = {r.doc_id: r.kept for r in quality_rules.judged(docs, labels.union(labels.limit(2))).collect()}
    assert all(got[i] for i in range(120))
    assert not any(got[i] for i in range(120, 160))
    assert SPACE.split("a b") == ["a", "b"]
