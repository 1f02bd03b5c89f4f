import os
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing  # noqa: E402

from lakesync.llm import toxicity as T  # noqa: E402

LABELS = "doc_id long, quality int, toxic int"


def model():
    rng = np.random.default_rng(0)
    known = np.sort(rng.integers(1, 1 << 62, 30).astype(np.uint64))
    return T.Model(known, np.ones(30), rng.normal(0, 2, (30, 3)), np.array([[2.0, 0.5], [0.6, 1.1]]), -1.5, np.zeros(5))


def test_runs_are_exact():
    fitted, rng = model(), np.random.default_rng(1)
    for n in (1, 2, 3, 10, 200, 3000):
        word = np.where(rng.random(n) < 0.05, rng.integers(0, 30, n), -1)
        places, marginal, _ = T.tagged(word, fitted)
        padded = np.concatenate([[-1], word, [-1]])
        score = fitted.bias + sum(np.where(padded[k : k + n] >= 0, fitted.scores[padded[k : k + n], k], 0) for k in range(3))
        unary = np.stack([np.ones(n), np.exp(score)], axis=1)[:, None, :]
        ahead, behind, _ = T.messages(unary, fitted.pairs)
        both = (ahead * behind)[:, 0]
        assert np.allclose((both[:, 1] / both.sum(axis=1))[places], marginal, atol=1e-9)


def test_messages_are_marginals_of_all_taggings():
    from itertools import product

    fitted, rng = model(), np.random.default_rng(2)
    unary = np.exp(rng.normal(size=(5, 1, 2)))
    ahead, behind, total = T.messages(unary, fitted.pairs)
    sums, each = 0.0, np.zeros(5)
    for tags in product((0, 1), repeat=5):
        p = np.prod([unary[i, 0, t] for i, t in enumerate(tags)]) * np.prod([fitted.pairs[a, b] for a, b in zip(tags, tags[1:], strict=False)])
        sums, each = sums + p, each + p * np.array(tags)
    both = (ahead * behind)[:, 0]
    assert np.allclose(both[:, 1] / both.sum(axis=1), each / sums) and np.isclose(np.exp(total[0]), sums)


def corpus(n=400):
    rows, labels = [], []
    for i in range(n):
        words = [f"word{(i * 31 + k * 7) % 211}" for k in range(60)]
        toxic = i % 8 == 0
        if toxic:
            words[10:10] = ["villain!", f"grumble{chr(97 + i % 26)}x"]
            words[30:30] = ["Nasty,"]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_learns_spans_and_holds_out(spark):
    rows, labels = corpus()
    docs = clashing(spark.createDataFrame(rows, SCHEMA), ["score", "predicted", "held_out", "toxic"])
    got = T.document_toxicity(docs, spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: t for i, _, t in labels}
    text = {r[0]: r[1] for r in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert held and all(r.predicted == truth[r.doc_id] for r in held)
    for r in got:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= T.THRESHOLD)
        for span in r.spans.split(",") if r.spans else ():
            a, b, _ = span.split(":")
            assert text[r.doc_id][int(a) : int(b)].rstrip("!,").lower() in ("villain", "nasty") or text[r.doc_id][int(a) : int(b)].startswith("grumble")


def test_held_out_rows_teach_nothing(spark):
    rows, labels = corpus(200)
    docs = spark.createDataFrame(rows, SCHEMA)
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    one, two = (sorted(T.document_toxicity(docs, spark.createDataFrame(x, LABELS)).select("doc_id", "score").collect()) for x in (labels, flipped))
    assert one == two


def test_whole_table(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    got = T.document_toxicity(docs, labels).collect()
    assert len(got) == docs.count()
    clean = [r for r in got if truth.get(r.doc_id) == 0]
    bad = [r for r in got if truth.get(r.doc_id) == 1]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in bad) >= 0.5 * len(bad)


def test_edges(spark):
    rows, labels = corpus(200)
    rows += [(900, None, "en", "s", 0), (901, "", "en", "s", 0), (902, "villain " + "plain " * 200_000, "en", "s", 0), (None, "x", "en", "s", 0), (3, rows[3][1], "en", "s", 0)]
    labels += [(None, 1, 1), (5, None, None), (6, 1, 1), (6, 1, 0)]
    got = T.document_toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == len(rows)
    score = {r.doc_id: r.score for r in got}
    assert score[900] == score[901] < T.THRESHOLD
    nothing = T.document_toxicity(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], LABELS)).collect()
    assert {(r.score, r.predicted) for r in nothing} == {(0.0, 0)}
    assert T.document_toxicity(spark.createDataFrame([], SCHEMA), spark.createDataFrame(labels, LABELS)).collect() == []
