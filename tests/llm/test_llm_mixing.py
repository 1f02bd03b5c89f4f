import os
import sys
from collections import defaultdict
from fractions import Fraction

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing, documents, words  # noqa: E402

from lakesync.llm import mixing  # noqa: E402


def brute_targets(sizes):
    """Reshare the excess by weight until no source is above three times its size."""
    order = sorted([s for s in sizes if s is not None], key=str.encode) + [s for s in sizes if s is None]
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, held = sum(sizes.values()), {}
    while True:
        rest = total - sum(held.values())
        free = [s for s in order if s not in held]
        share = {s: Fraction(rest * weight[s], sum(weight[x] for x in free)) for s in free}
        above = {s: 3 * sizes[s] for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return held | share
        held |= above


def check(got, rows):
    sizes = defaultdict(int)
    for _, source, size in rows:
        sizes[source] += size
    want = brute_targets(sizes)
    taken = defaultdict(int)
    assert sorted((r.doc_id, r.source, r.size) for r in got) == sorted(rows, key=lambda r: (r[0], str(r[1]), r[2])) or sorted(
        map(str, ((r.doc_id, r.source, r.size) for r in got))
    ) == sorted(map(str, rows))
    for r in got:
        assert r.source_size == sizes[r.source]
        assert abs(r.target - float(want[r.source])) < 1e-6
        assert 0 <= r.taken <= 3 * r.size
        taken[r.source] += r.taken
    for s, n in taken.items():
        assert abs(n - float(want[s])) <= max(mixing.BLOCK, 0.02 * float(want[s])), (s, n, want[s])


def test_targets_and_limits(spark):
    texts = []
    for source, n, each in (("b", 40, 100), ("a", 3, 30), (None, 2, 10), ("c", 200, 90), ("é", 5, 1)):
        texts += [("w " * each, source) for _ in range(n)]
    rows = [(i, t, "en", s, 1) for i, (t, s) in enumerate(texts)] + [(900, None, "en", "b", 0), (901, " \t\n", "en", "zero", 0), (5, "x y", "en", "b", 3), (5, "x y", "en", "b", 3)]
    docs = spark.createDataFrame(rows, SCHEMA)
    docs = clashing(docs, ["size", "start", "block", "of", "at", "run", "slots", "target", "words"])
    got = mixing.document_shares(docs).collect()
    check(got, [(r[0], r[3], len(words(r[1]))) for r in rows])
    again = mixing.document_shares(docs.repartition(7)).collect()
    key = lambda r: (r.doc_id, str(r.source), r.size, r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = [(r.doc_id, r.source, len(words(r.text))) for r in docs.collect()]
    check(mixing.document_shares(docs).collect(), rows)


def test_permutation_is_one(spark):
    from pyspark.sql import functions as F

    for n in (1, 2, 3, 17, 1000):
        rows = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3), F.lit("s"), F.lit(0)).alias("x")).collect()
        assert sorted(r.x for r in rows) == list(range(n))


def test_empty_and_wordless(spark):
    assert mixing.document_shares(spark.createDataFrame([], SCHEMA)).collect() == []
    got = mixing.document_shares(documents(spark, ["", None, "\n"])).collect()
    assert [(r.size, r.taken, r.target) for r in got] == [(0, 0, 0.0)] * 3


def test_long_text_and_blocks(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    docs = documents(spark, [long, "a b c"])
    got = {r.doc_id: r.taken for r in mixing.document_shares(docs).collect()}
    assert abs(sum(got.values()) - 200_003) <= mixing.BLOCK
    small = documents(spark, [" ".join(f"d{k}w{i}" for i in range(50 + k)) for k in range(20)])
    blocks = mixing.shard_blocks(small).collect()
    taken = sum(len(b.text.split(" ")) for b in blocks)
    assert taken == sum(r.taken for r in mixing.document_shares(small).collect())
    assert all(len(b.text.split(" ")) <= mixing.BLOCK for b in blocks)
