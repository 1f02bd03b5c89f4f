"""Landed change envelopes: files, topics, start positions, several instances."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.session import bounded_broadcast

# Where a change stream starts.
INITIAL = "INITIAL"
EARLIEST = "EARLIEST_OFFSET"
LATEST = "LATEST_OFFSET"
TIMESTAMP = "TIMESTAMP"


def read_envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Envelope documents of landed text files, one per line, as `value`."""
    return spark.read.text(path)


def land(envelopes: DataFrame, path: str) -> None:
    """Store envelope text by source database and table, so that a reader of some tables
    opens only their folders."""
    placed = envelopes.select(
        F.coalesce(F.get_json_object("value", "$.source.db"), F.lit("")).alias("db"),
        F.coalesce(F.get_json_object("value", "$.source.table"), F.lit("")).alias("table"),
        "value",
    )
    placed.hint("rebalance", "db", "table").write.mode("append").partitionBy("db", "table").parquet(path)


def read_landed(spark: SparkSession, path: str, tables: DataFrame | None = None) -> DataFrame:
    """Envelopes of a landed layout; with `tables` (db, table) the partition filter is
    found at run time and other tables are neither read nor parsed."""
    landed = spark.read.schema("value string, db string, table string").parquet(path)
    if tables is not None:
        # The inequality also tells the optimizer that the list is worth pruning with.
        named = tables.select("db", "table").where("table <> ''").distinct()
        landed = landed.join(bounded_broadcast(named), ["db", "table"], "left_semi")
    return landed.select("value")


def stream_envelopes(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Streaming form over a landing folder."""
    return spark.readStream.format("text").options(**options).load(path)


def stream_topics(spark: SparkSession, servers: str, topics: str, mode: str = INITIAL, ts_ms: int | None = None) -> DataFrame:
    """Streaming form over message topics; needs the Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topics)
        .options(**topic_start(mode, ts_ms))
        .load()
        .select(F.col("value").cast("string").alias("value"))
    )


def topic_start(mode: str | None, ts_ms: int | None = None) -> dict[str, str]:
    """Reader options for a start position."""
    mode = start_mode(mode, ts_ms)
    if mode == TIMESTAMP:
        return {"startingTimestamp": str(ts_ms)}
    return {"startingOffsets": "latest" if mode == LATEST else "earliest"}


def start_mode(mode: str | None, ts_ms: int | None = None) -> str:
    """Unset means INITIAL, or TIMESTAMP if a time is given; unknown modes are rejected."""
    if mode is None:
        return INITIAL if ts_ms is None else TIMESTAMP
    if mode not in (INITIAL, EARLIEST, LATEST, TIMESTAMP):
        raise ValueError(f"unsupported startup mode {mode!r}")
    if mode == TIMESTAMP and ts_ms is None:
        raise ValueError("TIMESTAMP needs a time")
    return mode


def after_position(file: str, pos: int) -> Column:
    """Changes strictly behind a log position."""
    number = S.file_number("file")
    bound = S.file_number(F.lit(file))
    return (number > bound) | ((number == bound) & (F.col("pos") > pos))


def start_from(
    changes: DataFrame,
    mode: str | None = None,
    *,
    ts_ms: int | None = None,
    end: tuple[str, int] | None = None,
) -> DataFrame:
    """Cut decoded changes to a start position.

    INITIAL takes snapshot and log, EARLIEST_OFFSET the log, TIMESTAMP the log from a
    time on, LATEST_OFFSET what follows `end`, the end of the log at job start.
    """
    mode = start_mode(mode, ts_ms)
    if mode == INITIAL:
        return changes
    log = changes.where(F.col("incremental") | (F.col("op") == S.DDL))
    if mode == TIMESTAMP:
        return log.where(F.col("ts_ms") >= ts_ms)
    if mode == LATEST:
        if end is None:
            raise ValueError("LATEST_OFFSET needs the end of the log")
        return log.where(after_position(*end))
    return log


def snapshot_then_log(snapshot: DataFrame, changes: DataFrame, high_watermark: tuple[str, int]) -> DataFrame:
    """Snapshot rows and the log behind the snapshot position as one feed."""
    log = changes.where(F.col("incremental") & after_position(*high_watermark))
    return snapshot.unionByName(log, allowMissingColumns=True)


def fan_in(feeds: Mapping[str, DataFrame]) -> DataFrame:
    """Feeds of several instances as one, each row naming its instance."""
    named = [df.withColumn("instance", F.lit(name)) for name, df in feeds.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)
