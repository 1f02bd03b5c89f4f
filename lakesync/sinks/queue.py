"""Change messages: one topic per target table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import naming
from lakesync.operators.quality import incremental_only


def messages(routed: DataFrame, env: str, key: str = "key", prefix: str = "flink") -> DataFrame:
    """Log changes as (topic, key, value) with the position to sort by.

    The body is {op, row}, the row as the source had it; deletes are sent too. The key
    is the JSON of the row key.
    """
    log = incremental_only(routed).where(F.col("op") != S.DDL)
    body = F.to_json(F.struct("op", "row"), {"ignoreNullFields": "false"})
    return log.select(
        naming.topic(env, F.col("dst_db"), F.col("dst_table"), prefix).alias("topic"),
        F.to_json(key).alias("key"),
        body.alias("value"),
        S.order_key().alias("position"),
    )


def write_files(out: DataFrame, path: str) -> None:
    """JSON files per topic whose name order is log order.

    Ranges over topic and position split a hot topic or key over many tasks.
    """
    ordered = out.repartitionByRange("topic", "position").sortWithinPartitions("topic", "position")
    ordered.select("topic", "key", "value").write.mode("overwrite").partitionBy("topic").json(path)


def topic_writer(servers: str) -> Callable[[DataFrame, str], None]:
    """Writer of message topics for SyncJob.write_messages; needs the Kafka connector."""
    return lambda out, _: write_topics(out, servers)


def in_key_order(out: DataFrame) -> DataFrame:
    """All messages of a key in one task, by position: consumers read them in order."""
    return out.repartition("topic", "key").sortWithinPartitions("topic", "key", "position")


def write_topics(out: DataFrame, servers: str) -> None:
    """Message topics; needs the Kafka connector. Changes of a key are sent in log order,
    as its topic partition is one sequence anyway; the position goes along as a header."""
    out = in_key_order(out)
    header = F.array(
        F.struct(F.lit("position").alias("key"), F.encode(F.to_json("position"), "utf-8").alias("value"))
    )
    (
        out.select("topic", "key", "value", header.alias("headers"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("includeHeaders", "true")
        .save()
    )
