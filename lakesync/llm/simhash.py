"""SimHash near-dedup: fingerprints within a small Hamming distance, compared as bit planes.

A text's fingerprint has a bit where more than half of its word shingles have it. Equal fingerprints
become one row first. The others meet by the pigeonhole principle: the bits are cut into RADIUS + 2
blocks, two fingerprints within RADIUS agree on two blocks at least, and for each choice of two
blocks the fingerprints that agree on both are a bucket. Buckets of more than MOST rows are cut
further, by the same rule over the bits that are still open, until they fit; a bucket with few open
bits cannot be large. So every bucket that a task compares is bounded, and no pair is left out.

A task lays the buckets of its shard after another and turns the rows into bit planes: one bitset a
bit, one lane a row. Shifting the planes by k lanes compares every row with the k-th next one: the
differing bits of all lanes are added up by carry-save counters, two bitsets that count to three
and one that remembers an overflow. Blocks of lanes that have all overflowed are abandoned. Links
are joined in the task, so that a bucket gives no more than a link a row however many pairs it has.

Rows: a null or empty text, and one without words, has fingerprint 0, linked like any other. Each row
is in the result, also of a repeated doc_id; a null doc_id stays null and is no smallest one. If all
rows of a component have a null doc_id, so has component_id. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import components, written

BITS, RADIUS, SHINGLE, SEED = 64, 3, 3, 42
# Rows of a bucket that a task compares.
MOST = 4096
# Bytes of a text that are hashed at a time, and the lanes of a block: 16 words of 64.
PIECE, LANES = 1 << 18, 1024
# Planes after which blocks are looked at.
STEP = 8
# Fixed value: white space, the same that bytes.split() takes.
SPACE = re.compile(rb"[\x20\x09-\x0D]")
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_runs(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text with A-Z lowered, a piece of some PIECE bytes at a time."""
    start = 0
    while start < len(text):
        end = start + PIECE
        space = SPACE.search(text, end) if end < len(text) else None
        end = space.start() if space else len(text)
        yield text[start:end].translate(LOWER).split()
        start = end


def shingle_hashes(text: bytes) -> Iterator[np.ndarray]:
    """XXH64 of the shingles of a text, a row of 8 bytes each; fewer words than a shingle are one."""
    digest, held, told = xxhash.xxh64_digest, [], False
    for words in word_runs(text):
        held += words
        if len(held) >= SHINGLE:
            shingles = map(b" ".join, zip(*(held[i:] for i in range(SHINGLE))))
            yield np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
            held, told = held[1 - SHINGLE :], True
    if held and not told:
        yield np.frombuffer(digest(b" ".join(held), SEED), np.uint8).reshape(-1, 8)


def fingerprint(text: bytes) -> int:
    """The majority of each bit over all shingles, as a signed 64-bit value."""
    ones, n = np.zeros(BITS, np.int64), 0
    for hashes in shingle_hashes(text):
        ones += np.unpackbits(hashes, axis=1).sum(axis=0, dtype=np.int64)
        n += len(hashes)
    return int(np.packbits(2 * ones > n).view(">i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, print): the fingerprint of each row."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            prints = [fingerprint(t.as_py() or b"") for t in texts]
            yield pa.record_batch([batch.column("doc_id"), pa.array(prints, pa.int64())], ["doc_id", "print"])

    wanted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return wanted.mapInArrow(run, "doc_id long, print long")


def choices(open_bits: list[int], radius: int) -> list[int]:
    """Masks of bits, on one of which at least any two values within the radius agree: two of radius + 2 blocks each."""
    blocks = [sum(1 << int(b) for b in part) for part in np.array_split(open_bits, radius + 2)]
    return [a | b for a, b in combinations(blocks, 2)]


def signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def levels(radius: int = RADIUS) -> list[dict[int, list[int]]]:
    """For each level, the masks that cut a bucket further, by the mask of the bits on which its rows agree.

    The last level leaves so few open bits that no bucket is larger than MOST.
    """
    out, masks = [], [0]
    while True:
        cut = {m: [m | c for c in choices([b for b in range(BITS) if not m >> b & 1], radius)] for m in masks}
        out.append(cut)
        masks = sorted({m for some in cut.values() for m in some})
        if max(BITS - m.bit_count() for m in masks) <= np.log2(MOST):
            return out


def cut(rows: DataFrame, level: dict[int, list[int]]) -> DataFrame:
    """(mask, key, print): each row once for each mask that its bucket's mask is cut into."""
    if list(level) == [0]:
        masks: Column = F.array(*[F.lit(signed(m)) for m in level[0]])
        return with_key(rows.select("print", F.explode(masks).alias("mask")))
    spark = rows.sparkSession
    table = spark.createDataFrame([(signed(m), signed(to)) for m, some in level.items() for to in some], "mask long, to long")
    # Some thousand rows, whatever the input. Buckets can be cut to the same mask and key; a row counts once in it.
    keyed = rows.join(F.broadcast(table), "mask").select("print", F.col("to").alias("mask")).distinct()
    return written(with_key(keyed), "simhash-buckets")


def with_key(rows: DataFrame) -> DataFrame:
    return rows.select("mask", F.col("print").bitwiseAND(F.col("mask")).alias("key"), "print")


def planes(values: np.ndarray) -> np.ndarray:
    """(bits, words) bitsets: bit b of all values, the first value in the lowest bit of the first word."""
    lanes = -(-len(values) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(lanes, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def shifted(bits: np.ndarray, by: int) -> np.ndarray:
    """Bitsets with lane i + by at lane i."""
    words, rest = divmod(by, 64)
    out = np.zeros_like(bits)
    if words < bits.shape[-1]:
        out[..., : bits.shape[-1] - words] = bits[..., words:]
    if rest:
        high = np.zeros_like(out)
        high[..., :-1] = out[..., 1:]
        out = (out >> np.uint64(rest)) | (high << np.uint64(64 - rest))
    return out


def near_lanes(bits: np.ndarray, by: int, wanted: np.ndarray, radius: int) -> np.ndarray:
    """Lanes of `wanted` whose value is within the radius (3 or less) of the one `by` lanes on.

    Two counters hold a distance up to three, a third bitset the lanes beyond it. Blocks without
    a lane that still counts are left out of the remaining planes.
    """
    if radius > 3:
        raise ValueError("two counters hold distances up to 3")
    width = LANES // 64
    blocks = np.flatnonzero(wanted.reshape(-1, width).any(axis=1))
    lanes = np.arange(width)
    at = (blocks[:, None] * width + lanes).ravel()
    left = wanted[at]
    ones, twos = np.zeros_like(left), np.zeros_like(left)
    other = shifted(bits, by)
    for b in range(BITS):
        differ = bits[b, at] ^ other[b, at]
        carry = ones & differ
        ones ^= differ
        over = twos & carry
        twos ^= carry
        left &= ~over
        if b % STEP == STEP - 1:
            alive = left.reshape(-1, width).any(axis=1)
            if not alive.any():
                return np.zeros(0, np.int64)
            if not alive.all():
                keep = np.repeat(alive, width)
                at, left, ones, twos = at[keep], left[keep], ones[keep], twos[keep]
    far = {0: ones | twos, 1: twos, 2: ones & twos, 3: np.zeros_like(left)}[radius]
    left &= ~far
    found = np.flatnonzero(np.unpackbits(left.view(np.uint8), bitorder="little"))
    return at[found // 64] * 64 + found % 64


def joined(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """roots, the smallest lane known to be linked to each lane, after links of lanes a with lanes b."""
    while True:
        low, high = np.minimum(roots[a], roots[b]), np.maximum(roots[a], roots[b])
        if (low == high).all():
            return roots
        np.minimum.at(roots, high, low)
        while (roots != roots[roots]).any():
            roots = roots[roots]


def bucket_links(buckets: np.ndarray, values: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Links (lane, lane) that join what is within the radius in each bucket, at most one a lane.

    buckets: number of each lane's bucket, ascending.
    """
    n = len(values)
    width = -(-n // LANES) * LANES
    bits = planes(np.concatenate([values, np.zeros(width - n, np.uint64)]))
    roots = np.arange(n)
    for k in range(1, n):
        same = np.zeros(width, bool)
        same[: n - k] = buckets[k:] == buckets[:-k]
        if not same.any():
            break
        lanes = near_lanes(bits, k, np.packbits(same, bitorder="little").view(np.uint64), radius)
        if len(lanes):
            roots = joined(roots, lanes, lanes + k)
    linked = np.flatnonzero(roots != np.arange(n))
    return linked, roots[linked]


def links(keyed: DataFrame, parts: int) -> DataFrame:
    """(a, b): fingerprints of one bucket that are within RADIUS, enough of them to join all that are."""

    def run(batches):
        held: list[np.ndarray] = []

        def compared(rows: np.ndarray):
            new = (rows[1:, 0] != rows[:-1, 0]) | (rows[1:, 1] != rows[:-1, 1])
            a, b = bucket_links(np.concatenate([[0], np.cumsum(new)]), rows[:, 2].view(np.uint64))
            return pa.record_batch([pa.array(rows[a, 2]), pa.array(rows[b, 2])], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.column_stack([batch.column(i).to_numpy() for i in range(3)]))
            rows = np.concatenate(held)
            # The last bucket may go on in the next batch.
            last = np.flatnonzero((rows[:, 0] != rows[-1, 0]) | (rows[:, 1] != rows[-1, 1]))
            whole = last[-1] + 1 if len(last) else 0
            held = [rows[whole:]]
            if whole:
                yield compared(rows[:whole])
        if held and len(held[0]):
            yield compared(held[0])

    ordered = keyed.select("mask", "key", "print").repartition(parts, "mask", "key").sortWithinPartitions("mask", "key", "print")
    return ordered.mapInArrow(run, "a long, b long")


def all_links(prints: DataFrame) -> DataFrame:
    """(a, b): links that join all distinct fingerprints within RADIUS, through buckets of at most MOST rows."""
    rows, found = prints, None
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = levels()
    for depth, level in enumerate(steps):
        keyed = cut(rows, level)
        # Counts begin before their shuffle, so no task ever holds a large bucket.
        sizes = written(keyed.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1"), "simhash-sizes")
        if depth + 1 == len(steps):
            small, large = keyed.join(sizes, ["mask", "key"], "left_semi"), None
        else:
            small = keyed.join(sizes.where(F.col("n") <= MOST), ["mask", "key"], "left_semi")
            large = keyed.join(sizes.where(F.col("n") > MOST), ["mask", "key"], "left_semi")
        some = written(links(small, parts), "simhash-links")
        found = some if found is None else found.union(some)
        if large is None or sizes.where(F.col("n") > MOST).isEmpty():
            return found.distinct()
        rows = written(large.select("mask", "print"), "simhash-large")
    return found.distinct()


def document_components(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint and component_id, the smallest doc_id reachable over links, of each row."""
    known = written(fingerprints(docs), "simhash-prints")
    smallest = written(known.groupBy("print").agg(F.min("doc_id").alias("first")), "simhash-distinct")
    roots = components(all_links(smallest.select("print")), "simhash")
    rooted = smallest.join(roots.select(F.col("node").alias("print"), "root"), "print", "left").select(
        "print", "first", F.coalesce("root", "print").alias("root")
    )
    classes = written(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-classes")
    named = rooted.join(classes, "root").select("print", "component_id")
    return known.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )
