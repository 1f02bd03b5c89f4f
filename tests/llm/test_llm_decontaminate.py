import math
import os
import random
import sys
from collections import Counter, defaultdict

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import SCHEMA, bare_words, clashing, documents  # noqa: E402

from lakesync.llm import decontaminate as D  # noqa: E402

ITEMS = "item_id long, text string"


def grams(w):
    return [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []


def brute(texts, items):
    """All (doc, item) of which some window of the item's size is similar enough."""
    bags = {i: Counter(grams(bare_words(t))) for i, t in items.items()}
    holders = Counter(g for b in bags.values() for g in b)
    weight = lambda g: math.log(1 + len(items) / holders[g]) if g in holders else math.log(1 + len(items))
    of = defaultdict(set)
    for i, b in bags.items():
        for g in b:
            of[g].add(i)
    out = set()
    for doc, text in texts.items():
        w = bare_words(text)
        own = grams(w)
        for i in set().union(*(of[g] for g in own if g in of)) if own else ():
            n = len(bare_words(items[i]))
            spans = max(1, n - 4)
            if n < 5 and len(w) != n:
                continue
            for s in range(max(1, len(own) - spans + 1)):
                b = Counter(own[s : s + spans])
                both = bags[i] | b
                if sum(weight(g) * min(bags[i][g], b[g]) for g in both) >= 0.75 * sum(weight(g) * max(bags[i][g], b[g]) for g in both):
                    out.add((doc, i))
                    break
    return out


def test_whole_tables(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    want = brute({r.doc_id: r.text for r in docs.collect()}, {r.item_id: r.text for r in bench.collect()})
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert want and got == want
    stay = {r.doc_id for r in D.clean(docs, bench).collect()}
    assert stay == {r.doc_id for r in docs.collect()} - {d for d, _ in want}


def test_changed_copies_and_passes(spark, monkeypatch):
    pick = random.Random(4)
    vocabulary = [f"v{i}" for i in range(400)]
    items = {i: " ".join(pick.choice(vocabulary) for _ in range(pick.randint(5, 60))) for i in range(40)}
    items |= {100: "one two three", 101: "", 102: None, 103: items[0]}
    texts = {}
    for k in range(120):
        item = items[pick.randrange(40)].split()
        for _ in range(pick.choice([0, 0, 1, 2, 4])):
            place = pick.randrange(len(item))
            item[place : place + pick.choice([0, 1])] = [pick.choice(vocabulary)]
        before, after = ([pick.choice(vocabulary) for _ in range(pick.choice([0, 3, 50]))] for _ in range(2))
        texts[k] = " ".join(before + item + after).title()
    texts |= {200: "One, two; THREE!", 201: "one two three four", 202: "", 203: None, 204: "x " * 100_000 + items[3], 205: items[5]}
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts.items()], SCHEMA), ["item_id", "similarity", "best"])
    bench = spark.createDataFrame(list(items.items()), ITEMS)
    want = brute(texts, {i: t for i, t in items.items() if t is not None})
    got = {(r.doc_id, r.item_id) for r in D.contaminated(docs, bench).collect()}
    assert (200, 100) in got and (204, 3) in got and (205, 5) in got
    # The windows tried begin where shared shingles say, and the radius may miss a pair at the very edge.
    assert got <= want and len(got) >= 0.98 * len(want)
    assert len(D.contaminated(docs.union(docs), bench).collect()) == len(got)
    monkeypatch.setattr(D, "PASS_CHARS", 3000)
    # Weights are those over all items, however many passes there are.
    one = sorted(map(tuple, D.contaminated(docs, bench).collect()))
    monkeypatch.setattr(D, "PASS_CHARS", 1 << 25)
    assert one == sorted(map(tuple, D.contaminated(docs, bench).collect()))


def test_lookup_guarantees_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 1 << 63, 50, dtype=np.uint64)
    windows = np.concatenate([prints ^ sum((np.uint64(1) << np.uint64(b) for b in rng.choice(64, k, False)), np.uint64(0)) for k in (0, 5, 12, 19, 20)])
    got = set(zip(*(x.tolist() for x in D.within_radius(windows, prints, D.blocks_index(prints), D.near_masks())), strict=True))
    want = {(w, i) for w in range(len(windows)) for i in range(50) if int(windows[w] ^ prints[i]).bit_count() <= D.RADIUS}
    assert got == want


def test_empty(spark):
    none, bench = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    assert D.contaminated(none, bench).collect() == []
    docs = documents(spark, ["a b c", None])
    assert D.contaminated(docs, bench).collect() == [] and D.clean(docs, bench).count() == 2
    assert D.contaminated(none, spark.createDataFrame([(1, "a b c d e f")], ITEMS)).collect() == []


def test_dirty_rows_go_whatever_their_id(spark):
    item = "one two three four five six seven eight"
    rows = [(None, f"x {item} y"), (None, "clean words of nobody else at all here"), (1, item), (1, "another row of this very id stays here"), (2, None)]
    docs = clashing(spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], SCHEMA), ["row", "item_id"])
    bench = spark.createDataFrame([(7, item), (7, "something else that nobody has in his text")], ITEMS)
    kept = D.clean(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([rows[1], rows[3], rows[4]], key=str)
