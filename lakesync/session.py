"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest metadata frame that is broadcast, in rows. Route and key frames hold a
# handful of names of at most 64 characters, so this is some tens of megabytes.
BROADCAST_ROWS = 100_000
# The same in bytes of text, for frames that are measured.
BROADCAST_BYTES = 1 << 27


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on: UTC clock and the TIME type.

    The method limit is the one of the JVM's compiler: rows of wide tables generate
    methods above it, which would run interpreted; below it Spark splits them instead.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.timeType.enabled", "true")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    Only a local session may fall back to a temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="lakesync-")
    spark.conf.set("spark.checkpoint.dir", folder)
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, name: str) -> str:
    """A new folder for one run below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df as Parquet files below the shared folder: computed once, read again by column."""
    path = run_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives executor loss and cuts the lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(df: DataFrame) -> DataFrame:
    """Split an input that has fewer partitions than the session has cores.

    For costly per-row work over a few small files; inputs with enough partitions, so
    every large one, pass unchanged and are not shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the frame is proven small, else leave the join to the optimizer.

    Meant for metadata that is cheap to count; beyond the bound the same join runs
    as a shuffled join whose skewed partitions adaptive execution splits.
    """
    rows = df.limit(max_rows + 1).count()
    return F.broadcast(df) if rows <= max_rows else df


def measured_broadcast(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The same by the bytes that a stored frame of names has, 64 a row besides its texts."""
    texts = [F.coalesce(F.octet_length(f.name), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    size = df.agg(F.sum(sum(texts, F.lit(64).cast("bigint")))).first()[0] or 0
    return F.broadcast(df) if size <= max_bytes else df
