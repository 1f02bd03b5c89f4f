"""A full read in chunks while the log goes on.

The key range is cut at quantiles, which a sketch of the key gives in one pass, so chunks hold
about as many rows each however skewed the key is; a value of the first key column that fills
several chunks is cut by the next column. Each chunk is read between two log positions: what the log
held before the low one is in the rows, what it has up to the high one may or may not be. So the
log of a chunk's keys counts from its low position on, and laid over the rows it gives the chunk as
of its high position. No table lock, no pause of the log, and a lost chunk is read again alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.session import bounded_broadcast, run_dir

# Cells of the sketch for each chunk, and its accuracy: the error of a quantile is a share of 1 / ACCURACY rows.
CELLS, ACCURACY = 4, 100_000

MARKS = "chunk INT, low_file STRING, low_pos BIGINT, high_file STRING, high_pos BIGINT"


def chunk_bounds(table: DataFrame, keys: Sequence[str], chunks: int) -> list[tuple]:
    """Ascending first keys of all chunks but the first; a None in one stands for the smallest value.

    Key columns are numbers, dates or times. One pass over the keys, and one more for each
    further key column that hot values of the ones before need.
    """
    cells = CELLS * chunks
    found = [((), cells, 0.0)]
    fine: list[tuple[float, tuple]] = []
    for depth, name in enumerate(keys):
        hot = []
        for (prefix, parts, rank), values in zip(found, _quantiles(table, keys[:depth], name, [f[0] for f in found], cells), strict=True):
            # parts - 1 cuts, evenly taken from the sketch's
            cuts = [values[round(i * cells / parts) - 1] for i in range(1, parts)] if values else []
            times, step = Counter(cuts), 1 / cells
            for i, v in enumerate(cuts, 1):
                if i == 1 or cuts[i - 2] != v:
                    fine.append((rank + i * step, (*prefix, v)))
                    if times[v] > 1:
                        hot.append(((*prefix, v), times[v] + 1, rank + i * step))
        found = hot
        if not found:
            break
    fine.sort(key=lambda f: f[0])
    ranks = [r for r, _ in fine]
    picked = {min(range(len(ranks)), key=lambda j: abs(ranks[j] - k / chunks)) for k in range(1, chunks)} if fine else set()
    return [(*fine[j][1], *[None] * (len(keys) - len(fine[j][1]))) for j in sorted(picked)]


def _quantiles(table: DataFrame, before: Sequence[str], name: str, prefixes: list[tuple], cells: int) -> list[list]:
    """Values of a key column at the cells' borders, for each prefix of the columns before it."""
    at = F.percentile_approx(name, [i / cells for i in range(1, cells)], ACCURACY).alias("at")
    if not before:
        return [table.agg(at).first()["at"] or []]
    types = dict(table.dtypes)
    wanted = table.sparkSession.createDataFrame(prefixes, ", ".join(f"`{c}` {types[c]}" for c in before))
    # At most as many rows as there are cells.
    rows = table.join(F.broadcast(wanted), list(before), "left_semi").groupBy(*before).agg(at).collect()
    known = {tuple(r)[:-1]: r["at"] for r in rows}
    return [known.get(p, []) for p in prefixes]


def chunk_of(keys: Sequence[Column], bounds: Sequence[tuple], types: Sequence[str]) -> Column:
    """Number of the chunk of a key, by binary search over the bounds."""
    if not bounds:
        return F.lit(0)

    def row(values) -> Column:
        return F.struct(*[v.cast(t).alias(f"k{i}") for i, (v, t) in enumerate(zip(values, types, strict=True))])

    firsts = F.array(*[row([F.lit(v) for v in b]) for b in bounds])
    key = row(keys)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(bounds).bit_length()))])

    def further(at: Column, step: Column) -> Column:
        reached = F.get(firsts, at + step - 1)
        return F.when((at + step <= len(bounds)) & (reached <= key), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further)


def predicates(keys: Sequence[str], bounds: Sequence[tuple], quote: str = "`") -> list[str]:
    """Conditions of all chunks as SQL, for a reader that takes one a partition."""

    def text(value) -> str:
        return str(value) if isinstance(value, (int, float)) or type(value).__name__ == "Decimal" else f"'{value}'"

    def from_on(bound: tuple) -> str:
        parts, same = [], []
        known = [(f"{quote}{k}{quote}", text(v)) for k, v in zip(keys, bound, strict=True) if v is not None]
        for i, (k, v) in enumerate(known):
            parts.append(" AND ".join([*same, f"{k} {'>=' if i + 1 == len(known) else '>'} {v}"]))
            same.append(f"{k} = {v}")
        return "(" + " OR ".join(f"({p})" for p in parts) + ")"

    lows = [None, *map(from_on, bounds)]
    highs = [*(f"NOT {from_on(b)}" for b in bounds), None]
    return [" AND ".join(x for x in pair if x) or "1 = 1" for pair in zip(lows, highs, strict=True)]


def read_chunks(
    spark: SparkSession,
    read: Callable[[list[str]], DataFrame],
    conditions: Sequence[str],
    position: Callable[[], tuple[str, int]],
    at_once: int,
) -> tuple[DataFrame, DataFrame]:
    """Rows of all chunks, stored in the shared folder, and their MARKS.

    `read` gives the rows of some chunks, a partition each; `position` is the present end of the
    log. `at_once` chunks are read by one job, between the same two positions.
    """
    stored, marks = [], []
    for first in range(0, len(conditions), at_once):
        some = list(conditions[first : first + at_once])
        low = position()
        path = run_dir(spark, "chunks")
        rows = read(some)
        rows.write.parquet(path)
        high = position()
        stored.append(spark.read.schema(rows.schema).parquet(path))
        marks += [(first + i, *low, *high) for i in range(len(some))]
    return reduce(DataFrame.unionByName, stored), spark.createDataFrame(marks, MARKS)


def _behind(file: str, pos: str) -> Column:
    """A change lies behind the log position of these columns."""
    return F.struct(S.file_number("file"), F.col("pos")) > F.struct(S.file_number(file), F.col(pos).cast("bigint"))


def marked(log: DataFrame, chunk: Column, marks: DataFrame) -> DataFrame:
    """Changes behind the low position of the chunk of their key, with `_after`: also behind the high one.

    Earlier ones are in the rows that were read. The marks are a row a chunk.
    """
    named = bounded_broadcast(marks.withColumnRenamed("chunk", "_chunk"))
    near = log.withColumn("_chunk", chunk).join(named, "_chunk").where(_behind("low_file", "low_pos"))
    return near.select(*log.columns, _behind("high_file", "high_pos").alias("_after"))


def chunked_feed(snapshot: DataFrame, log: DataFrame, chunk: Column, marks: DataFrame) -> DataFrame:
    """Snapshot rows of all chunks and the log that they lack, as one feed to fold."""
    return snapshot.unionByName(marked(log, chunk, marks).drop("_after"), allowMissingColumns=True)


def settled_chunks(snapshot: DataFrame, log: DataFrame, chunk: Column, marks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(feed of the chunks as of their high positions, log behind those), for targets that are filled before the log starts."""
    near = marked(log, chunk, marks)
    inside = near.where("not _after").drop("_after")
    return snapshot.unionByName(inside, allowMissingColumns=True), near.where("_after").drop("_after")
