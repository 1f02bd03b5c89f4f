import os
import random
import sys
from itertools import permutations

import duckdb
import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, clashing, words  # noqa: E402

from lakesync.llm import filter_audit as A  # noqa: E402


def brute(rows, labels):
    """The audit by running every order over every row. rows: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    facts = []
    for i, text, lang in rows:
        text = text or ""
        w = words(text)
        fails = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in rows),
        }
        good = any(j == i and q == 1 for j, q, _ in labels if i is not None)
        toxic = any(j == i and t == 1 for j, _, t in labels if i is not None)
        facts.append((lang or "", fails, good, toxic))
    out = {}
    for part in {f[0] for f in facts}:
        mine = [f[1:] for f in facts if f[0] == part]
        credit = dict.fromkeys("ABCDE", 0)
        some = {}
        for order in permutations("ABCDE"):
            left, gone = mine, []
            for step, f in enumerate(order, 1):
                out_now = [x for x in left if x[0][f]]
                redundant = sum(x[0][f] for x in gone)
                left = [x for x in left if not x[0][f]]
                gone = gone + out_now
                credit[f] += len(out_now)
                only = sum(x[0][f] and sum(x[0].values()) == 1 for x in mine)
                some["".join(order), step] = [len(left), len(out_now), redundant, only, sum(x[1] for x in out_now), sum(x[2] for x in out_now), f]
        for (order, step), values in some.items():
            out[part, order, step] = (*values[:-1], credit[values[-1]])
    return out


def got(spark, rows, labels, names=()):
    docs = clashing(spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], SCHEMA), names)
    marks = clashing(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), names)
    found = A.audited(docs, marks)
    assert found.schema.simpleString() == spark.createDataFrame([], A.SCHEMA).schema.simpleString()
    return {tuple(r)[:3]: tuple(r)[3:] for r in found.collect()}


def test_min_plus_ranks():
    steps = A.removal_steps(np.arange(32))
    for mask in range(32):
        for k, order in enumerate(A.ORDERS):
            assert steps[mask, k] == min([i for i, f in enumerate(order, 1) if mask >> A.FILTERS.index(f) & 1], default=6)


def test_brute_force(spark):
    pick = random.Random(4)
    body = [f"w{i}" for i in range(400)]
    kinds = [
        lambda: " ".join(pick.sample(body, 250)),
        lambda: " ".join(pick.choice(body[:20]) for _ in range(250)),
        lambda: " ".join(pick.sample(body, 5)),
        lambda: " ".join(w.upper() if pick.random() < 0.2 else w for w in pick.sample(body, 220)),
        lambda: " ".join(pick.sample(body, 210)) + " 5 & 6",
        lambda: "A",
        lambda: pick.choice(["", None, "\n", "ä€ " * 230]),
    ]
    texts = [pick.choice(kinds)() for _ in range(60)]
    rows = [(pick.randint(1, 90), pick.choice(texts), pick.choice(["en", "de", "", None])) for _ in range(150)]
    rows += [(None, texts[0], "en"), (None, texts[0], "en"), (0, texts[1], None), (rows[0][0], rows[0][1], rows[0][2])]
    labels = [(pick.randint(0, 60), pick.choice([0, 1, None]), pick.choice([0, 1, None])) for _ in range(60)] + [(None, 1, 1)]
    names = ["part", "mask", "digest", "n", "words", "first", "good", "smallest", "some"]
    assert got(spark, rows, labels, names) == brute(rows, labels)


def test_edges(spark):
    assert got(spark, [], [(1, 1, 1)]) == {}
    one = got(spark, [(1, None, None)], [])
    assert len(one) == 600 and one["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)
    long = " ".join(f"x{i}" for i in range(100_000))
    assert got(spark, [(1, long, "en"), (2, long, "de")], []) == brute([(1, long, "en"), (2, long, "de")], [])


def test_sql(spark, sf_dir):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    found = A.audited(*(spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels")))
    want = con.sql(A.AUDIT_SQL)
    assert found.columns == want.columns
    assert sorted(tuple(r) for r in found.collect()) == sorted(want.fetchall())
