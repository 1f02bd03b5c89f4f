import os
import sys
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing, documents  # noqa: E402

from lakesync.llm import language  # noqa: E402


def test_forward_sums_all_segmentations():
    names = [b" a", b"a", b"ab", b" ab", b"b", b"bab"]
    data = np.frombuffer(b"".join(names), np.uint8)
    ends = np.cumsum([len(x) for x in names])
    hashes = language.hashed(data, ends - np.array([len(x) for x in names]), ends)
    rng = np.random.default_rng(0)
    odds = rng.random((len(hashes) + 256, 2))
    odds /= odds.sum(axis=0)
    texts = [b"a", b"abab", b"babab", b"zzab", b"b" * 60]
    joined = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(x) for x in texts])
    lattice = language.Lattice(joined, ends - np.array([len(x) for x in texts]), ends, hashes, language.index(hashes))

    def total(word, k):
        sums = [1.0] + [0.0] * len(word)
        for i in range(len(word)):
            for size in range(1, len(word) - i + 1):
                piece = word[i : i + size]
                p = odds[names.index(piece), k] if piece in names else odds[len(names) + piece[0], k] if size == 1 else 0
                sums[i + size] += sums[i] * p
        return np.log(sums[-1])

    got = lattice.logs(odds)
    for i, text in enumerate(texts):
        for k in range(2):
            assert abs(got[i, k] - total(b" " + text, k)) < 1e-9
    # Expected uses against the derivative of the likelihood.
    counts = rng.random((len(texts), 2))
    used = lattice.expected(odds, counts)
    step = 1e-6
    for piece in range(len(names)):
        more = odds.copy()
        more[piece] *= 1 + step
        slope = (counts * (lattice.logs(more) - got)).sum(axis=0) / step
        assert np.allclose(slope, used[piece], atol=1e-3)


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = language.document_languages(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got)


def test_edges(spark):
    rows = [(i, f"the house and the tree are here {i}", "en", "s", 1) for i in range(20)]
    rows += [(100 + i, f"das haus und der baum sind hier {i}", "de", "s", 1) for i in range(20)]
    odd = [(200, None, "en", "s", 0), (201, "", "en", "s", 0), (202, "12 ... !!", None, "s", 0), (203, "the tree", None, "s", 0)]
    odd += [(None, "das haus", "de", "s", 0), (204, "und der baum " * 100_000, None, "s", 0), (205, "x" * 500_000, None, "s", 0), (203, "the tree", None, "s", 0)]
    docs = clashing(spark.createDataFrame(rows + odd, SCHEMA), ["score", "lang_pred", "rate", "of", "_text", "row"])
    got = [(r.doc_id, r.lang_pred, r.score) for r in language.document_languages(docs).collect()]
    assert len(got) == len(rows) + len(odd)
    told = {}
    for doc, lang, _ in got:
        told.setdefault(doc, set()).add(lang)
    assert told[200] == told[201] == told[202] == {"und"}
    assert told[203] == {"en"} and told[None] == told[204] == {"de"}
    assert language.document_languages(spark.createDataFrame([], SCHEMA)).collect() == []
    nothing = language.document_languages(documents(spark, ["the house"], lang=None)).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]


def test_long_words_that_a_language_has_not_seen(spark):
    line = "─" * 30
    for learned in (False, True):
        rows = [(i, f"the house and the tree are here {i} " * 550 + f"\n{line}" * (learned and i == 1), "en", "s", 1) for i in range(80)]
        rows += [(100 + i, f"das haus und der baum sind hier {i} " * 550, "de", "s", 1) for i in range(80)]
        rows += [(200, f"the house and the tree\n{line}\nare here", None, "s", 0), (201, "das haus " + "я" * 200, None, "s", 0)]
        assert zlib.crc32(b"1") % 5
        got = {r.doc_id: r for r in language.document_languages(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert got[200].lang_pred == "en"
        assert not learned or got[201].lang_pred == "de"
        assert all(0 <= r.score <= 1 for r in got.values())
        assert all(r.lang_pred == ("en" if i < 100 else "de") for i, r in got.items() if i < 200)


def test_sums_of_long_words_stay_in_range():
    names = [b" a", b"a", b"ab"]
    data = np.frombuffer(b"".join(names), np.uint8)
    ends = np.cumsum([len(x) for x in names])
    hashes = language.hashed(data, ends - np.array([len(x) for x in names]), ends)
    odds = np.full((len(hashes) + 256, 2), 1e-9)
    texts = [b"z" * 64, b"ab" * 32]
    ends = np.cumsum([len(x) for x in texts])
    lattice = language.Lattice(np.frombuffer(b"".join(texts), np.uint8), ends - np.array([len(x) for x in texts]), ends, hashes, language.index(hashes))
    assert np.allclose(lattice.logs(odds)[0], 65 * np.log(1e-9))
    used = lattice.expected(odds, np.array([[3.0, 0.0], [0.0, 0.0]]))
    assert np.allclose(used[len(hashes) + ord("z")], [192.0, 0.0]) and np.allclose(used.sum(axis=0), [195.0, 0.0])
