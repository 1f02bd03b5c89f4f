"""Initial full reads of source tables as change records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync import schemas as S

# Fixed value: rows per fetch of a snapshot read.
FETCH_SIZE = 1024


def jdbc_options(
    url: str,
    table: str,
    *,
    column: str | None = None,
    bounds: tuple[object, object] | None = None,
    partitions: int = 1,
    user: str | None = None,
    password: str | None = None,
) -> dict[str, str]:
    """Reader options; with a column and bounds the table is read in parallel ranges."""
    options = {"url": url, "dbtable": table, "fetchsize": str(FETCH_SIZE)}
    if user is not None:
        options |= {"user": user, "password": password or ""}
    if column is not None:
        low, high = bounds
        options |= {
            "partitionColumn": column,
            "lowerBound": str(low),
            "upperBound": str(high),
            "numPartitions": str(partitions),
        }
    return options


def read_table(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Source table over JDBC."""
    return spark.read.format("jdbc").options(**options).load()


def snapshot(
    rows: DataFrame,
    instance: str,
    db: str,
    table: str,
    *,
    file: str | None = None,
    pos: int | None = None,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Table rows as INSERT changes of a snapshot taken at a log position."""
    image = F.to_variant_object(F.struct(*(columns or rows.columns)))
    none = F.lit(None)
    return rows.select(
        F.lit(instance).alias("instance"),
        F.lit(db).alias("db"),
        F.lit(table).alias("table"),
        F.lit(S.INSERT).cast("tinyint").alias("op"),
        image.alias("row"),
        none.cast("string").alias("ddl"),
        F.lit(file).cast("string").alias("file"),
        F.lit(pos).cast("bigint").alias("pos"),
        F.lit(0).alias("row_no"),
        F.lit(0).cast("bigint").alias("ts_ms"),
        F.lit(False).alias("incremental"),
        none.cast("variant").alias("before"),
        none.cast("string").alias("document"),
        none.cast("string").alias("_reason"),
    )
