"""What several operators share: stored intermediate tables, vectorised words, components."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakesync.session import run_dir

# Bytes of text that a task holds as arrays at a time; one longer text makes a slice of its own.
SLICE_BYTES = 1 << 19
# The bytes of white space, as in the class [\x20\x09-\x0D].
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's setting to remove the shuffle files of a query when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table below the shared folder: computed once, lineage cut, safe from lost executors.

    Nothing else reads the shuffles of its query, so they need not wait for the driver's garbage collection.
    """
    spark = df.sparkSession
    path = run_dir(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def discard(stored: DataFrame) -> None:
    """Delete a written table that only finished steps have read."""
    spark = stored.sparkSession
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


class sent:
    """A value for all tasks, pickled with its classes, so that a worker needs no copy of the package."""

    def __init__(self, spark: SparkSession, value):
        self.pickled = spark.sparkContext.broadcast(cloudpickle.dumps(value))

    @property
    def value(self):
        return pickle.loads(self.pickled.value)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """A stored table dealt out by a key, so that joins and groups by the key in one query share the exchange.

    No column has nulls; said so here, the optimizer adds no filter below one of the uses only.
    """
    return df.where(" and ".join(f"{c} is not null" for c in df.columns)).repartition(key)


def other_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of df but for these: results replace columns of their names, in any case of letters."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def schema_of(df: DataFrame, columns: list[str]) -> StructType:
    """The schema of some columns of df."""
    return StructType([f for f in df.schema.fields if f.name in columns])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the splitmix finaliser); changes x in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudorandom 64-bit values."""
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed << 32)) * GOLDEN)


BYTE_VALUES = stream(256, 1)
SPREAD = stream(64, 2) | np.uint64(1)
BASE = int(stream(1, 3)[0]) | 1


class Local(dict):
    """A cache that stays in its process: it travels empty."""

    def __reduce__(self):
        return Local, ()


_powers: dict[int, np.ndarray] = Local()


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, SLICE_BYTES + 1), base, dtype=np.uint64)
        have[0] = 1
        _powers[base] = have = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def text_slices(column: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of consecutive rows of a text column; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, end, raw[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def byte_classes(separators, skipped=()) -> np.ndarray:
    """1 for bytes of words, 0 for separators, 2 for bytes to leave out."""
    kinds = np.ones(256, np.uint8)
    kinds[list(separators)] = 0
    kinds[list(skipped)] = 2
    return kinds


PLAIN_WORDS = byte_classes(SPACE_BYTES)
# Words without ASCII punctuation.
BARE_WORDS = byte_classes(SPACE_BYTES, [b for b in range(33, 127) if not chr(b).isalnum()])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(
    data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray = PLAIN_WORDS, longest: int | None = None, prefixes: tuple[int, ...] = ()
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of the rows of one slice, A-Z lowered: 64-bit hash, row, first and end byte.

    Byte positions count in the data as it is after skipped bytes have gone. Words of more
    than `longest` bytes come as several. With `prefixes`, hashes has a column for the word and
    one for its beginning of each of these sizes in bytes, 0 where the word is not longer.
    """
    kind = kinds[data]
    if (kind == 2).any():
        keep = kind != 2
        offsets = np.concatenate([[0], np.cumsum(keep, dtype=np.int64)])[offsets]
        data, kind = data[keep], kind[keep]
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros((0, 1 + len(prefixes)) if prefixes else 0, np.uint64), none, none, none
    inside = kind == 1
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    begins = offsets[:-1][offsets[:-1] < n]
    first[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > 0] - 1
    last[ends] = inside[ends]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if longest and len(start) and (end - start).max() > longest:
        parts = -(-(end - start) // longest)
        begin = np.repeat(np.cumsum(parts) - parts, parts)
        start, end = np.repeat(start, parts) + (np.arange(len(begin)) - begin) * longest, np.repeat(end, parts)
        end = np.minimum(end, start + longest)
    summed = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[LOWER[data]] * powers(BASE, n), out=summed[1:])
    back = powers(pow(BASE, -1, 1 << 64), n)[start]
    hashes = mixed((summed[end] - summed[start]) * back)
    if prefixes:
        hashes = np.column_stack([hashes, np.zeros((len(hashes), len(prefixes)), np.uint64)])
        for k, size in enumerate(prefixes, 1):
            some = np.flatnonzero(end - start > size)
            hashes[some, k] = mixed((summed[start[some] + size] - summed[start[some]]) * back[some]) ^ SPREAD[32 + size]
    return hashes, np.searchsorted(offsets, start, "right") - 1, start, end


def shingles(hashes: np.ndarray, rows: np.ndarray, size: int, short: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, index of the first word) of each window of `size` words of a row.

    With `short`, a row of fewer words gives its whole sequence as one.
    """
    n = len(hashes)
    full = np.zeros(0, np.int64)
    if n >= size:
        full = np.flatnonzero(rows[size - 1 :] == rows[: n - size + 1])
    out = np.zeros(len(full), np.uint64)
    for j in range(size):
        out += hashes[full + j] * SPREAD[j]
    out = mixed(out)
    if not short:
        return out, rows[full], full
    begins = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]])) if n else full
    counts = np.diff(np.append(begins, n))
    some = counts < size
    begins, counts = begins[some], counts[some]
    whole = counts.astype(np.uint64) * GOLDEN
    for j in range(size - 1):
        has = counts > j
        whole[has] += hashes[begins[has] + j] * SPREAD[j]
    return (
        np.concatenate([out, mixed(whole)]),
        np.concatenate([rows[full], rows[begins]]),
        np.concatenate([full, begins]),
    )


def distinct_sets(tokens: np.ndarray, rows: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct tokens of each row, all rows after another, and the offsets of the rows."""
    order = np.lexsort((tokens, rows))
    tokens, rows = tokens[order], rows[order]
    keep = np.ones(len(tokens), bool)
    keep[1:] = (tokens[1:] != tokens[:-1]) | (rows[1:] != rows[:-1])
    tokens, rows = tokens[keep], rows[keep]
    return tokens, np.searchsorted(rows, np.arange(count + 1))


def components(edges: DataFrame, name: str) -> DataFrame:
    """(node, root): the smallest node reachable over edges (a, b), for every node of an edge.

    Each round hooks every tree of pointers to the smallest root next to it and then jumps
    along pointers, so the number of rounds grows with the logarithm of the longest path.
    Every round is a written table; a node with very many edges is aggregated before its shuffle.
    """
    edges = edges.select("a", "b").where("a != b")
    both = written(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-edges")
    roots = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("root")), f"{name}-roots")
    while True:
        # The smallest root that a neighbour of any member of a tree points to.
        near = (
            both.join(roots.select(F.col("node").alias("b"), F.col("root").alias("there")), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("there").alias("there"))
        )
        seen = roots.join(near, "node").select("node", "root", F.least("root", "there").alias("best"))
        hooks = seen.groupBy("root").agg(F.min("best").alias("to"))
        moved = written(
            seen.join(hooks, "root").select("node", F.col("root").alias("was"), F.least("best", "to").alias("root")), f"{name}-roots"
        )
        jump = moved.select(F.col("node").alias("root"), F.col("root").alias("up"))
        roots = written(
            moved.join(jump, "root", "left").select("node", "was", F.least("root", F.coalesce("up", "root")).alias("root")),
            f"{name}-roots",
        )
        if roots.where("root != was").isEmpty():
            return roots.select("node", "root")
        roots = roots.select("node", "root")
