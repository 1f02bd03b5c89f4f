"""Ordered change history per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.session import stored
from lakesync.sources.chunks import chunk_bounds, chunk_of

# Columns of the position by which a feed is cut into segments, and their types.
POSITION = {"_log": "int", "_file_no": "bigint", "_pos": "bigint"}


def change_history(changes: DataFrame, keys: Sequence[str], segments: int | None = None) -> DataFrame:
    """Add `version`, `valid_from` and `valid_to` (time of the next change) per key.

    A key may own a third of the feed, and the feed may be a single log file, so no window covers
    a whole key. The feed is cut at quantiles of its positions into segments of about as many
    rows each (as many as shuffle partitions, by default); windows run over a key's rows in one segment.
    One summary row per key and segment carries over what lies at the border: the rows
    before the segment and the first change after it. The changes are stored first, so they
    are parsed once; later steps read the columns they need.
    """
    parts = segments or int(changes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    position = {
        "_log": F.col("incremental").cast("int"),
        "_file_no": F.coalesce(S.file_number("file"), F.lit(-1)),
        "_pos": F.coalesce(F.col("pos").cast("bigint"), F.lit(-1)),
    }
    rows = stored(changes.withColumns({**position, "_ord": S.order_key()}), "history")
    bounds = chunk_bounds(rows, list(POSITION), parts)
    rows = rows.withColumn("_chunk", chunk_of([F.col(c) for c in POSITION], bounds, list(POSITION.values())))
    part = [*keys, "_chunk"]

    summary = rows.groupBy(*part).agg(F.count(F.lit(1)).alias("_rows"), F.min_by("ts_ms", "_ord").alias("_first"))
    by_key = Window.partitionBy(*keys).orderBy("_chunk")
    summary = summary.select(
        *part,
        F.coalesce(F.sum("_rows").over(by_key.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(by_key).alias("_next"),
    )

    inside = Window.partitionBy(*part).orderBy("_ord")
    numbered = rows.withColumns(
        {
            "_rn": F.row_number().over(inside),
            "_lead": F.lead("ts_ms").over(inside),
            "_last": F.lead(F.lit(1)).over(inside).isNull(),
        }
    )
    joined = numbered.join(summary, part)
    return joined.select(
        *changes.columns,
        (F.col("_before") + F.col("_rn")).alias("version"),
        F.col("ts_ms").alias("valid_from"),
        F.when(F.col("_last"), F.col("_next")).otherwise(F.col("_lead")).alias("valid_to"),
    )
