import os
import random
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing, lowered, words  # noqa: E402

from lakesync.llm import simhash as S  # noqa: E402


def shingle_list(text):
    w = words(lowered(text))
    return [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []


def brute_print(hashes):
    n = len(hashes)
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_roots(values, radius=S.RADIUS):
    """Smallest value reachable, by comparing all pairs."""
    values = np.unique(np.array(values, np.uint64))
    roots = list(range(len(values)))

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1 :] ^ values[i]) <= radius) + i + 1:
            a, b = sorted((find(i), find(int(j))))
            roots[b] = a
    return {int(v): int(values[find(i)]) for i, v in enumerate(values)}


def brute_components(rows):
    """rows: (doc_id, fingerprint)."""
    roots = brute_roots([p for _, p in rows])
    first = {}
    for i, p in rows:
        if i is not None:
            first[roots[p]] = min(i, first.get(roots[p], i))
    return [first.get(roots[p]) for _, p in rows]


def test_hash_is_that_of_the_engine(spark):
    texts = ["One two  three\tfour", "a b", "x", "ÄÖ ß 日本 語 x", "long " * 40, "A1 B2 C3 D4 " + "w" * 200 + " end"]
    for text in texts:
        shingles = shingle_list(text)
        hashes = [r.h & (1 << 64) - 1 for r in spark.createDataFrame([(s,) for s in shingles], "s string").select(F.xxhash64("s").alias("h")).collect()]
        assert S.fingerprint(text.encode()) & (1 << 64) - 1 == brute_print(hashes), text


def test_pieces_change_nothing(monkeypatch):
    pick = random.Random(1)
    text = "".join(pick.choice(["ab ", "C", "\n", "  ", "déf ", "x" * 30]) for _ in range(3000)).encode()
    whole = S.fingerprint(text)
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(S, "PIECE", piece)
        assert S.fingerprint(text) == whole
        assert S.fingerprint(b"two words") == S.fingerprint(b"TWO\n words ")
    assert S.fingerprint(b"") == S.fingerprint(b" \n") == 0


@pytest.mark.parametrize("radius", [0, 1, 2, 3])
def test_planes_against_pairs(radius):
    pick = np.random.default_rng(radius)
    base = pick.integers(0, 1 << 63, 40, dtype=np.uint64)
    values = []
    for b in base:
        for _ in range(pick.integers(1, 120)):
            flips = pick.integers(0, 7)
            values.append(b ^ np.uint64(sum(1 << int(x) for x in pick.choice(64, flips, replace=False))))
    values = np.array(values, np.uint64)
    buckets = np.sort(pick.integers(0, 12, len(values)))
    a, b = S.bucket_links(buckets, values, radius)
    assert len(a) < len(values) and (buckets[a] == buckets[b]).all()
    roots = S.joined(np.arange(len(values)), a, b)
    for bucket in range(12):
        lanes = np.flatnonzero(buckets == bucket)
        want = brute_roots(values[lanes], radius)
        seen = {}
        for lane in lanes:
            assert seen.setdefault(want[int(values[lane])], roots[lane]) == roots[lane]
        assert len(set(seen.values())) == len(seen)


def test_choices_leave_out_no_pair():
    pick = random.Random(5)
    open_bits = [b for b in range(64) if b % 3]
    masks = S.choices(open_bits, 3)
    for _ in range(300):
        differ = sum(1 << b for b in pick.sample(open_bits, 3))
        assert any(not differ & m for m in masks)


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = S.document_components(docs).collect()
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert sorted(texts) == sorted(r.doc_id for r in got)
    for r in got:
        assert int(r.fingerprint, 16) == S.fingerprint((texts[r.doc_id] or "").encode()) & (1 << 64) - 1
    rows = [(r.doc_id, int(r.fingerprint, 16)) for r in got]
    assert [r.component_id for r in got] == brute_components(rows)


def test_large_buckets_are_cut(spark, monkeypatch):
    """A third of all fingerprints agree on most bits; buckets above the limit go through further levels."""
    monkeypatch.setattr(S, "MOST", 16)
    pick = random.Random(2)
    centre = pick.getrandbits(64)
    near = {centre ^ sum(1 << b for b in pick.sample(range(64), pick.randint(0, 6))) for _ in range(400)}
    tail = {centre & ~((1 << 9) - 1) | pick.getrandbits(9) for _ in range(100)}
    values = sorted(near | tail | {pick.getrandbits(64) for _ in range(500)} | {0, (1 << 64) - 1, (1 << 63)})
    prints = spark.createDataFrame([(S.signed(v),) for v in values], "print long")
    got = S.all_links(prints).collect()
    back = (1 << 64) - 1
    roots = {v: v for v in values}

    def find(x):
        while roots[x] != x:
            x = roots[x]
        return x

    for r in got:
        a, b = sorted((find(r.a & back), find(r.b & back)))
        roots[b] = a
    assert {v: find(v) for v in values} == brute_roots(values)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(200_000))
    rows = [(5, ""), (3, None), (8, " \n"), (1, "one two"), (2, "ONE\ttwo"), (2, "ONE\ttwo"), (2, "something else entirely here"), (None, "one two")]
    rows += [(None, "nobody has this text but me and me"), (9, long), (10, long.upper() + " "), (11, "z" * 300_000)]
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA), ["print", "mask", "key", "root", "first", "node", "component_id"])
    got = S.document_components(docs).collect()
    want = [(i, S.fingerprint((t or "").encode()) & (1 << 64) - 1) for i, t in rows]
    expected = sorted(((i, f"{p:016x}", c) for (i, p), c in zip(want, brute_components(want))), key=str)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got), key=str) == expected
    assert {r.component_id for r in got if r.doc_id in (3, 5, 8)} == {3}
    assert S.document_components(spark.createDataFrame([], SCHEMA)).count() == 0
