"""Uniqueness of keys without moving the keys.

Each task turns its keys into hashes and these into a compressed list per bucket, a few bytes a key;
hashes of a bucket met twice, in one list or in two, are suspects. Only rows with a suspected hash,
or with a NULL in the key, are then counted exactly, so what is reported does not depend on the hash.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.operators.fold import key_violations
from lakesync.session import run_dir

# Bits of a hash that are compared within a bucket, and keys of a task that become lists at a time.
BITS, HELD = 32, 1 << 20


def _hash(keys: Sequence[str]) -> Column:
    return F.xxhash64(*keys).bitwiseAND(F.lit((1 << 62) - 1))


def _packed(values: np.ndarray) -> bytes:
    """Ascending numbers as steps of seven bits a byte, the top bit set where a step goes on."""
    steps = np.diff(values, prepend=np.zeros(1, np.uint64))
    size = np.maximum(1, -(-np.ceil(np.log2(steps.astype(np.float64) + 1)).astype(np.int64) // 7))
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, np.uint8)
    for place in range(int(size.max()) if len(size) else 0):
        some = np.flatnonzero(size > place)
        part = (steps[some] >> np.uint64(7 * place)) & np.uint64(127)
        out[end[some] - size[some] + place] = part.astype(np.uint8) | np.where(size[some] > place + 1, 128, 0).astype(np.uint8)
    return out.tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    last = np.flatnonzero(raw < 128)
    first = np.concatenate([[0], last[:-1] + 1])
    steps = np.zeros(len(last), np.uint64)
    for place in range(int((last - first).max()) + 1 if len(last) else 0):
        some = np.flatnonzero(last - first >= place)
        steps[some] |= (raw[first[some] + place] & 127).astype(np.uint64) << np.uint64(7 * place)
    return np.cumsum(steps, dtype=np.uint64)


def key_lists(table: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """(bucket, once, twice): lists of the hashes that some rows of one task have, and of those that they have twice."""

    def lists(hashes: np.ndarray) -> pa.RecordBatch:
        bucket = hashes % np.uint64(buckets)
        short = (hashes // np.uint64(buckets)) & np.uint64((1 << BITS) - 1)
        order = np.lexsort((short, bucket))
        bucket, short = bucket[order], short[order]
        new = np.ones(len(short), bool)
        new[1:] = (short[1:] != short[:-1]) | (bucket[1:] != bucket[:-1])
        again = np.unique(np.cumsum(new)[~new] - 1)
        bucket, short = bucket[new], short[new]
        names, begin = np.unique(bucket, return_index=True)
        once = [_packed(part) for part in np.split(short, begin[1:])]
        twice = [_packed(short[again[(again >= a) & (again < b)]]) for a, b in zip(begin, np.append(begin[1:], len(short)), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(names.astype(np.int32)), pa.array(once, pa.binary()), pa.array(twice, pa.binary())], names=["bucket", "once", "twice"])

    def run(batches: Iterator[pa.RecordBatch]):
        held, count = [], 0
        for batch in batches:
            held.append(batch.column(0).to_numpy().view(np.uint64))
            count += len(held[-1])
            if count >= HELD:
                yield lists(np.concatenate(held))
                held, count = [], 0
        if count:
            yield lists(np.concatenate(held))

    whole = [F.col(k).isNotNull() for k in keys]
    rows = table
    for condition in whole:
        rows = rows.where(condition)
    return rows.select(_hash(keys).alias("h")).mapInArrow(run, "bucket int, once binary, twice binary")


def suspects(lists: DataFrame) -> DataFrame:
    """(bucket, short): hashes that more than one row may have."""

    def run(batches: Iterator[pa.RecordBatch]):
        bucket, held, twice = None, [], []
        for batch in batches:
            for name, once, again in zip(*(batch.column(c).to_pylist() for c in ("bucket", "once", "twice")), strict=True):
                if name != bucket:
                    yield from told(bucket, held, twice)
                    bucket, held, twice = name, [], []
                held.append(_unpacked(once))
                twice.append(_unpacked(again))
        yield from told(bucket, held, twice)

    def told(bucket, held, twice):
        if not held:
            return
        short = np.sort(np.concatenate(held))
        short = np.unique(np.concatenate([short[1:][short[1:] == short[:-1]], *twice]))
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(short), bucket, np.int32)), pa.array(short.view(np.int64))], names=["bucket", "short"])

    dealt = lists.repartition("bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(run, "bucket int, short long")


def suspected_violations(table: DataFrame, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """What fold.key_violations gives: keys that occur more than once, or hold a NULL, with their rows."""
    spark = table.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = run_dir(spark, "suspects")
    suspects(key_lists(table, keys, n)).write.parquet(path)
    # Stored, so its size is known when the join is planned: a few suspects are broadcast, and the table stays where it is.
    known = spark.read.schema("bucket int, short long").parquet(path)
    hashed = table.select(*keys, _hash(keys).alias("_hash"))
    some = hashed.select(*keys, F.expr(f"cast(_hash % {n} as int)").alias("bucket"), F.expr(f"(_hash div {n}) & {(1 << BITS) - 1}").alias("short"))
    hit = some.join(known, ["bucket", "short"], "left_semi").select(*keys)
    nulls = F.lit(False)
    for k in keys:
        nulls = nulls | F.col(k).isNull()
    return key_violations(hit.where(~nulls).unionByName(table.where(nulls).select(*keys)), keys)
