import os
import random
import sys
from collections import Counter, defaultdict

import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing, documents, shingle_set  # noqa: E402

from lakesync.llm import jaccard as J  # noqa: E402


def brute(rows):
    """(doc_id, size of its set, smallest linked doc_id) of (doc_id, text) rows; rows of one doc_id are one node."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    above = {i: i for i, _ in sets}

    def find(x):
        while above[x] != x:
            x = above[x]
        return x

    holders = defaultdict(list)
    for k, (i, s) in enumerate(sets):
        for other, n in Counter(o for g in s for o in holders[g]).items():
            if 100 * n >= 75 * (len(s) + len(sets[other][1]) - n):
                a, b = sorted((find(i), find(sets[other][0])))
                above[b] = a
        for g in s:
            holders[g].append(k)
    return sorted((i, len(s), find(i)) for i, s in sets)


def got(docs):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in J.document_components(docs).collect())


def changed(pick, words, share):
    return [pick.choice(VOCABULARY) if pick.random() < share else w for w in words]


VOCABULARY = [f"w{i}" for i in range(3000)]


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert got(docs) == brute([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("seed", [1, 2])
def test_families_chains_and_common_passages(spark, seed):
    pick = random.Random(seed)
    passage = [pick.choice(VOCABULARY) for _ in range(60)]
    texts = []
    for _ in range(25):  # families of near copies, copies of copies and chains along which the ends do not link
        base = [pick.choice(VOCABULARY) for _ in range(pick.randint(20, 150))]
        chain = base
        for _ in range(pick.randint(1, 9)):
            chain = changed(pick, chain, 0.015)
            texts += [chain, changed(pick, base, 0.02), base[: int(len(base) * pick.uniform(0.7, 1))], base]
    for _ in range(60):  # the same passage with own words around it, at and around the threshold
        own = [pick.choice(VOCABULARY) for _ in range(pick.choice([5, 8, 12, 20, 100]))]
        texts.append(passage + own)
    texts += [["a"], ["A"], ["a", "b"], ["a", "b", "c", "d", "e"], []]
    pick.shuffle(texts)
    rows = [(i * 3 + 1, " ".join(t)) for i, t in enumerate(texts)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    assert got(docs) == brute(rows)


def test_edges(spark):
    long = " ".join(f"x{i}" for i in range(60_000))
    rows = [(1, ""), (2, None), (3, " \n"), (4, "one two"), (5, "ONE\ttwo"), (6, long), (7, long + " end"), (9, "p q r s t u"), (9, "p q r s t u"), (8, "p q r s t u v")]
    # Rows of one doc_id tie what each of them links with.
    rows += [(20, "aa bb cc dd ee ff"), (20, "gg hh ii jj kk ll"), (21, "aa bb cc dd ee ff"), (22, "gg hh ii jj kk ll")]
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA), ["rep", "n", "told", "goes", "cluster", "token", "tokens", "row", "at"])
    assert got(docs) == brute(rows)
    none = docs.selectExpr("cast(null as long) as doc_id", "text")
    assert {r.component_id for r in J.document_components(none).collect()} == {None}
    assert got(spark.createDataFrame([], SCHEMA)) == []
    for table in (docs, none.withColumn("lang", none.text)):
        kept = J.one_of_each(table)
        assert kept.columns == table.columns
        before = [(r.doc_id, r.text) for r in table.collect()]
        # Each row a node: a component of rows keeps one, of the smallest doc_id in it.
        component = [c for _, _, c in sorted(brute(list(enumerate(t for _, t in before))))]
        held = sorted(component[k] for k in (before.index((r.doc_id, r.text)) for r in kept.collect()))
        assert len(held) == len(set(component)) or len(set(held)) == len(set(component))
        for r in kept.collect():
            own = component[before.index((r.doc_id, r.text))]
            ids = [i for (i, _), c in zip(before, component, strict=True) if c == own and i is not None]
            assert r.doc_id == (min(ids) if ids else None)


def test_rows_of_one_id_lose_only_to_rows_they_link_with(spark):
    a, b, c = "aa bb cc dd ee ff gg", "hh ii jj kk ll mm nn", "oo pp qq rr ss tt uu"
    rows = [(1, a), (1, b), (2, b), (3, None), (3, c), (3, ""), (4, c), (None, a), (None, "own words of this very row here")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA)
    kept = sorted(((r.doc_id, r.text) for r in J.one_of_each(docs).collect()), key=str)
    assert kept == sorted([(1, a), (1, b), (3, None), (3, c), (3, ""), (None, "own words of this very row here")], key=str)


def test_many_copies_cost_no_pairs(spark):
    pick = random.Random(3)
    base = [pick.choice(VOCABULARY) for _ in range(80)]
    texts = [" ".join(base)] * 300 + [" ".join(changed(pick, base, 0.01)) for _ in range(300)]
    docs = documents(spark, texts)
    assert got(docs) == brute(list(enumerate(texts)))


def test_texts_with_much_of_a_frequent_passage_do_not_meet(spark, monkeypatch):
    """A passage of 96 shingles links texts with few words of their own, not these with texts of more."""
    passage = " ".join(f"common{i}" for i in range(100))
    lines = [(i, passage + "".join(f" own{i}x{j}" for j in range(10 if i < 20 else 30 + i % 4))) for i in range(40)]
    docs = spark.createDataFrame(lines, "doc_id long, text string").coalesce(1)
    met = []

    def counted(rows, whole=J.candidates):
        found = whole(rows)
        met.append(found.count())
        return found

    monkeypatch.setattr(J, "candidates", counted)
    found = {r["doc_id"]: r["component_id"] for r in J.document_components(docs).collect()}
    assert found == {i: 0 if i < 20 else i for i in range(40)}
    assert met == [0]


def test_near_copies_with_many_edits_do_not_all_meet(spark, monkeypatch):
    """Copies of a text with 1 to 9 edits: those with few link, and not each pair of them must become a row."""
    pick = random.Random(6)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for k in range(400):
        own = list(base)
        # The small ids win ties between centres and have three edits, so what they miss is most of the family.
        for e in range((3, 1, 2, 6, 7, 8, 9, 6)[k * 8 // 400]):
            own[pick.randrange(150)] = f"e{k}x{e}"
        texts.append(" ".join(own))
    docs = documents(spark, texts)
    rows = {}

    def counted(df, name, whole=J.written):
        out = whole(df, name)
        rows[name] = rows.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(J, "written", counted)
    assert got(docs) == brute(list(enumerate(texts)))
    assert {n: c for n, c in rows.items() if n in ("jaccard-candidates", "jaccard-asked", "jaccard-pairs", "jaccard-links") and c > 10 * len(texts)} == {}
