"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming lookup, exact check.

Words are compared lower-cased and without ASCII punctuation. A window can only be similar to an
item if it shares a shingle with it, and the places of the shared shingles say where item-sized
windows begin; so every text is read whole, but only such windows get a fingerprint. The 64
bits of a fingerprint are `BLOCKS` blocks. Two fingerprints within `RADIUS` differ in some block
by at most RADIUS // BLOCKS bits, so looking up every value that near in every block finds all
items within the radius. The exact similarity of these decides: shingles weighted by how few
items have them, sum of minima over sum of maxima, at least `THRESHOLD`.

An item of fewer than five words is one shingle, its whole sequence, and only meets a text that
is that sequence. Rows: null and empty texts or items match nothing; repeated rows match each;
items with the same id keep one row per document, that of the best window. Other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import BARE_WORDS, sent, shingles, text_slices, words, written

SIZE = 5
THRESHOLD = 0.75
BLOCKS, RADIUS = 4, 19
WIDTH = 64 // BLOCKS
# Characters of items that a pass over the documents compares them with; more items take more passes.
PASS_CHARS = 1 << 25
SLOT_BITS = np.uint64(44)
# Windows looked up at a time.
WINDOWS = 256


class Items(NamedTuple):
    """ids, words and bags of shingles of items; all their shingles sorted, with weights and the (item, place) that have them."""

    ids: list
    lengths: np.ndarray
    bags: list[dict[int, int]]
    shingles: np.ndarray
    weights: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    # Weight of a shingle that no item has.
    rare: float
    prints: np.ndarray


def fingerprints(tokens: np.ndarray, weights: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """SimHash of the stretches start:end of tokens: each bit is the sign of the weighted sum of that bit of the hashes."""
    planes = np.unpackbits(tokens.view(np.uint8).reshape(-1, 8), axis=1).astype(np.float32) * 2 - 1
    summed = np.zeros((len(tokens) + 1, 64))
    np.cumsum(planes * weights[:, None], axis=0, out=summed[1:])
    return np.packbits(summed[end] - summed[start] > 0, axis=1).view(np.uint64).ravel()


def indexed(ids: list, texts: pa.Array, known: np.ndarray, holders: np.ndarray, total: int) -> Items:
    """Items of a pass. known: sorted shingles, of all items of the pass at least, and how many of the `total` items have each."""
    tokens, owners, places = [], [], []
    lengths = np.zeros(len(ids), np.int64)
    for low, high, data, offsets in text_slices(texts):
        hashes, rows, _, _ = words(data, offsets, BARE_WORDS)
        lengths[low:high] = np.bincount(rows, minlength=high - low)
        begins = np.searchsorted(rows, np.arange(high - low))
        token, row, at = shingles(hashes, rows, SIZE)
        order = np.lexsort((at, row))
        tokens.append(token[order])
        owners.append(low + row[order])
        places.append((at - begins[row])[order])
    token, owner, place = (np.concatenate(x) if x else np.zeros(0, t) for x, t in ((tokens, np.uint64), (owners, np.int64), (places, np.int64)))
    order = np.argsort(token, kind="stable")
    unique, first = np.unique(token[order], return_index=True)
    weights = np.log(1 + total / holders[np.searchsorted(known, unique)])
    bounds = np.searchsorted(owner, np.arange(len(ids) + 1))
    bags = [dict(Counter(token[a:b].tolist())) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    prints = fingerprints(token, weights[np.searchsorted(unique, token)], bounds[:-1], bounds[1:]) if len(token) else np.zeros(len(ids), np.uint64)
    return Items(ids, lengths, bags, unique, weights, np.append(first, len(token)), owner[order], place[order], float(np.log(1 + total)), prints)


def near_masks() -> np.ndarray:
    """All values of a block with at most RADIUS // BLOCKS bits set."""
    values = np.arange(1 << WIDTH, dtype=np.int64)
    return values[np.bitwise_count(values) <= RADIUS // BLOCKS]


def blocks_index(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each block, the items sorted by its value and the first of each value."""
    out = []
    for b in range(BLOCKS):
        value = ((prints >> np.uint64(b * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
        order = np.argsort(value, kind="stable")
        out.append((order, np.searchsorted(value[order], np.arange((1 << WIDTH) + 1))))
    return out


def within_radius(windows: np.ndarray, prints: np.ndarray, index: list, masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(window, item) of all fingerprints within RADIUS bits of a window's."""
    out = []
    for low in range(0, len(windows), WINDOWS):
        part = windows[low : low + WINDOWS]
        found = []
        for b, (order, first) in enumerate(index):
            value = ((part >> np.uint64(b * WIDTH)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)
            near = value[:, None] ^ masks
            count = first[near + 1] - first[near]
            window, mask = np.nonzero(count)
            count, at = count[window, mask], first[near[window, mask]]
            each = np.repeat(np.arange(len(count)), count)
            step = np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
            found.append(np.column_stack([window[each] + low, order[at[each] + step]]))
        pairs = np.unique(np.concatenate(found), axis=0)
        out.append(pairs[np.bitwise_count(windows[pairs[:, 0]] ^ prints[pairs[:, 1]]) <= RADIUS])
    pairs = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
    return pairs[:, 0], pairs[:, 1]


def similarity(bag: dict[int, int], other: dict[int, int], weight: dict[int, float], rare: float) -> float:
    """Sum of weighted minima over sum of weighted maxima of two bags."""
    low = high = 0.0
    for token in bag.keys() | other.keys():
        a, b = bag.get(token, 0), other.get(token, 0)
        w = weight.get(token, rare)
        low, high = low + w * min(a, b), high + w * max(a, b)
    return low / high if high else 0.0


def matches(texts: pa.Array, items: Items, index: list, masks: np.ndarray, weight: dict[int, float], taken: np.ndarray):
    """(row, item, similarity, first word, end word) of the best window of each row and item that is similar."""
    known = items.shingles
    for low, high, data, offsets in text_slices(texts):
        hashes, rows, _, _ = words(data, offsets, BARE_WORDS)
        tokens, row, at = shingles(hashes, rows, SIZE)
        maybe = np.flatnonzero(taken[tokens >> SLOT_BITS])
        if not len(maybe):
            continue
        number = np.minimum(np.searchsorted(known, tokens[maybe]), len(known) - 1)
        hit = known[number] == tokens[maybe]
        maybe, number = maybe[hit], number[hit]
        count = items.first[number + 1] - items.first[number]
        each = np.repeat(np.arange(len(count)), count)
        entry = items.first[number][each] + np.arange(len(each)) - np.repeat(np.cumsum(count) - count, count)
        item, place = items.item[entry], items.place[entry]
        begins, ends = np.searchsorted(rows, np.arange(high - low)), np.searchsorted(rows, np.arange(high - low), "right")
        r = row[maybe][each]
        start = np.maximum(at[maybe][each] - place, begins[r])
        windows = np.unique(np.column_stack([r, start, np.minimum(start + items.lengths[item], ends[r])]), axis=0)
        # Texts of fewer than five words have one shingle; it is in its place after the others.
        whole = ends - begins < SIZE
        short = np.full(high - low, -1, np.int64)
        lone = np.flatnonzero(whole[row])
        short[row[lone]] = lone
        # Shingle i of a longer row begins at its word i; numbers of shingles by first word.
        number_at = np.full(len(hashes) + 1, -1, np.int64)
        full = np.flatnonzero(~whole[row])
        number_at[at[full]] = full
        first = np.where(whole[windows[:, 0]], short[windows[:, 0]], number_at[windows[:, 1]])
        last = np.where(whole[windows[:, 0]], first + 1, first + (windows[:, 2] - windows[:, 1]) - SIZE + 1)
        some = (first >= 0) & (last > first)
        windows, first, last = windows[some], first[some], last[some]
        if not len(windows):
            continue
        # Only the shingles of windows, laid out one window after another.
        sizes = last - first
        spread = np.repeat(first - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        part = tokens[spread]
        place = np.minimum(np.searchsorted(known, part), len(known) - 1)
        weights = np.where(known[place] == part, items.weights[place], items.rare)
        stop = np.cumsum(sizes)
        prints = fingerprints(part, weights, stop - sizes, stop)
        best: dict[tuple[int, int], tuple[float, int, int]] = {}
        for w, i in zip(*(x.tolist() for x in within_radius(prints, items.prints, index, masks)), strict=True):
            r, a, b = windows[w].tolist()
            if items.lengths[i] < SIZE and not (whole[r] and b - a == items.lengths[i]):
                continue
            score = similarity(Counter(part[stop[w] - sizes[w] : stop[w]].tolist()), items.bags[i], weight, items.rare)
            if score >= THRESHOLD - 1e-12:
                begin = int(begins[r])
                best[r, i] = min(best.get((r, i), (1.0, 0, 0)), (-score, a - begin, b - begin))
        for (r, i), (score, a, b) in best.items():
            yield low + r, i, -score, a, b


def shingle_holders(listed: DataFrame) -> DataFrame:
    """(token, holders): how many of all items have a shingle, whatever pass they are in."""

    def run(batches):
        for batch in batches:
            for low, high, data, offsets in text_slices(batch.column("text")):
                hashes, rows, _, _ = words(data, offsets, BARE_WORDS)
                token, row, _ = shingles(hashes, rows, SIZE)
                pairs = np.unique(np.column_stack([token, row.astype(np.uint64)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0].view(np.int64))], names=["token"])

    return listed.select("text").mapInArrow(run, "token long").groupBy("token").agg(F.count("*").alias("holders"))


def passes(benchmark: DataFrame) -> Iterator[Items]:
    """The items, about PASS_CHARS characters at a time, so what is broadcast is bounded; weights are those over all items."""
    listed = written(benchmark.where("text is not null and item_id is not null").select("item_id", "text").distinct(), "decontaminate-items")
    chars, total = listed.agg(F.sum(F.length("text")), F.count("*")).first()
    if not chars:
        return
    holders = written(shingle_holders(listed), "decontaminate-holders")
    number = -(-chars // PASS_CHARS)
    of = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for n in range(number):
        part = listed.where(of == n)
        chosen = part.orderBy("item_id", "text").toArrow()
        own = shingle_holders(part).select("token")
        table = (holders if number == 1 else holders.join(own, "token", "left_semi")).toArrow()
        known, counts = table.column("token").to_numpy().view(np.uint64), table.column("holders").to_numpy()
        order = np.argsort(known)
        items = indexed(chosen.column("item_id").to_pylist(), chosen.column("text").combine_chunks(), known[order], counts[order], total)
        if len(items.shingles):
            yield items


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, similarity, first_word, end_word) of every document and item that it holds a passage like."""
    item_type = dict(benchmark.dtypes)["item_id"]
    doc_type = dict(docs.dtypes)["doc_id"]
    schema = f"doc_id {doc_type}, item_id {item_type}, similarity double, first_word long, end_word long"
    out = docs.sparkSession.createDataFrame([], schema)
    for items in passes(benchmark):
        out = out.union(searched(docs, items, schema))
    # Items that share an id are one.
    best = F.min_by(F.struct("similarity", "first_word", "end_word"), F.struct(-F.col("similarity"), "first_word"))
    return out.groupBy("doc_id", "item_id").agg(best.alias("best")).select("doc_id", "item_id", "best.*")


def lookup(fitted: Items):
    """What `matches` needs of the items of a pass."""
    weight = dict(zip(fitted.shingles.tolist(), fitted.weights.tolist(), strict=True))
    taken = np.zeros(1 << (64 - int(SLOT_BITS)), bool)
    taken[fitted.shingles >> SLOT_BITS] = True
    return blocks_index(fitted.prints), near_masks(), weight, taken


def searched(docs: DataFrame, items: Items, schema: str) -> DataFrame:
    shared = sent(docs.sparkSession, items)

    def run(batches):
        fitted = shared.value
        known = lookup(fitted)
        for batch in batches:
            found = list(matches(batch.column("text"), fitted, *known))
            if not found:
                continue
            row, item, score, first, end = zip(*found, strict=True)
            ids = pa.array([fitted.ids[i] for i in item], item_type)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row)), ids, pa.array(score), pa.array(first), pa.array(end)],
                names=["doc_id", "item_id", "similarity", "first_word", "end_word"],
            )

    item_type = pa.array(items.ids).type
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that hold no passage of the benchmark, row by row, whatever their doc_id."""
    # The rows travel as one struct, so that no name of theirs can clash.
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col("text").cast("string").alias("text"))
    for items in passes(benchmark):
        shared = sent(docs.sparkSession, items)
        rows = rows.mapInArrow(undisturbed(shared), rows.schema)
    return rows.select("row.*")


def undisturbed(shared):
    """Keeps the rows of a batch that match no item."""

    def run(batches):
        fitted = shared.value
        known = lookup(fitted)
        for batch in batches:
            keep = np.ones(batch.num_rows, bool)
            keep[[m[0] for m in matches(batch.column("text"), fitted, *known)]] = False
            yield batch.filter(pa.array(keep))

    return run
