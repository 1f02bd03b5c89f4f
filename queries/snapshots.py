"""Full reads beside a running log."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import wire
from lakesync.operators import decode, fold, quality
from lakesync.operators.typed import typed_rows
from lakesync.sources import chunks, snapshot
from queries import feed as E
from queries.state import RESULT

CHUNKS = 8


def log_parts(spark, sf_dir):
    """Every event as a change of one table's log, in the order of its id."""
    e = E.event_parts(E.table(spark, sf_dir, "events"))
    op = F.when(F.col("op") == "r", "c").otherwise(F.col("op"))
    return e.withColumn("op", op).withColumn("key", F.col("image.id"))


def log_changes(parts):
    deleted = F.col("op") == "d"
    docs = parts.select(
        E.envelope(
            F.col("op"), F.when(deleted, F.col("image")), F.when(~deleted, F.col("image")), F.lit("shop"), F.lit("t_event"),
            F.lit(1).cast("bigint"), F.lit("bin.000001"), F.col("event_id"),
        ).alias("value")
    )
    return decode.decode(docs)


def as_read(parts, chunk, marks):
    """Rows of each chunk as a reader sees them halfway between its two log positions."""
    halfway = F.expr("(low_pos + high_pos) div 2")
    seen = parts.withColumn("chunk", chunk).join(F.broadcast(marks), "chunk").where(F.col("event_id") <= halfway)
    last = seen.groupBy("key").agg(F.max_by(F.struct("op", "image"), "event_id").alias("last"))
    return last.where("last.op <> 'd'").select("last.image.*")


def read_beside_log(spark, sf_dir):
    """Bounds from the keys, and marks that lie one after another in the log, with changes inside every chunk's."""
    parts = log_parts(spark, sf_dir)
    bounds = chunks.chunk_bounds(parts, ["key"], CHUNKS)
    end = parts.agg(F.max("event_id").alias("end")).first()["end"]
    step = end // (len(bounds) + 4)
    at = [(i, "bin.000001", step * (i + 1), "bin.000001", step * (i + 2)) for i in range(len(bounds) + 1)]
    marks = spark.createDataFrame(at, chunks.MARKS)
    rows = as_read(parts, chunks.chunk_of([F.col("key")], bounds, ["bigint"]), marks)
    taken = snapshot.snapshot(rows, "i0", "shop", "t_event")
    key = F.try_variant_get("row", wire.field_path("id"), "bigint")
    return taken, log_changes(parts), chunks.chunk_of([key], bounds, ["bigint"]), marks


def typed(changes):
    return quality.accepted(typed_rows(changes, E.EVENT_COLUMNS, carry=S.bookkeeping()))


def chunked_snapshot_current(spark, sf_dir):
    """Chunks with the log laid over them up to their high positions, then the log behind those."""
    inside, behind = chunks.settled_chunks(*read_beside_log(spark, sf_dir))
    target = fold.current(fold.fold(typed(inside), ["id"]), ["id"], fold.LAKE)
    return E.event_result(fold.apply(target, fold.fold(typed(behind), ["id"]), ["id"], fold.LAKE))


def chunked_feed_current(spark, sf_dir):
    """The same as one feed, folded once."""
    states = fold.fold(typed(chunks.chunked_feed(*read_beside_log(spark, sf_dir))), ["id"])
    return E.event_result(fold.current(states, ["id"], fold.LAKE))


def chunk_balance(spark, sf_dir):
    """Lines by order and number, cut at quantiles of both: rows in all chunks, and chunks above twice the mean."""
    lines = E.table(spark, sf_dir, "lineitem").withColumn("hot", F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")))
    # A third of all rows has one value of the first key column.
    keys = ["hot", "l_partkey"]
    bounds = chunks.chunk_bounds(lines, keys, 2 * CHUNKS)
    types = [dict(lines.dtypes)[k] for k in keys]
    sizes = lines.groupBy(chunks.chunk_of([F.col(k) for k in keys], bounds, types).alias("chunk")).agg(F.count("*").alias("n"))
    mean = lines.count() / (len(bounds) + 1)
    balance = F.when(F.col("n") > 2 * mean, "uneven").otherwise("even").alias("balance")
    return sizes.groupBy(balance).agg(F.sum("n").alias("rows"), F.count("*").alias("chunks"))


CHUNKED = f"""WITH {E.E_SQL},
cur AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id DESC) AS rn FROM e) WHERE rn = 1 AND op <> 3)
SELECT {RESULT} FROM cur"""

QUERIES = {
    "chunked_snapshot_current": chunked_snapshot_current,
    "chunked_feed_current": chunked_feed_current,
    "chunk_balance": chunk_balance,
}

ORACLE = {
    "chunked_snapshot_current": CHUNKED,
    "chunked_feed_current": CHUNKED,
    "chunk_balance": f"SELECT count(*) AS rows, CAST({2 * CHUNKS} AS BIGINT) AS chunks, 'even' AS balance FROM lineitem",
}
