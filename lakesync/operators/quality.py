"""Quarantine, audits and reconciliation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S

BLANK_OFFSET = "blank_offset"


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_reason").isNull()).drop("_reason")


def quarantined(rows: DataFrame) -> DataFrame:
    """Rows set aside, reason first."""
    rest = [c for c in rows.columns if c != "_reason"]
    return rows.where(F.col("_reason").isNotNull()).select(F.col("_reason").alias("reason"), *rest)


def incremental_only(changes: DataFrame) -> DataFrame:
    """Changes of the log, without the snapshot."""
    return changes.where("incremental")


def without_deletes(changes: DataFrame) -> DataFrame:
    """Drop physical deletes (opt-in); pair it with delete_audit."""
    return changes.where(F.col("op") != S.DELETE)


def delete_audit(changes: DataFrame, application: str) -> DataFrame:
    """One row per physical delete with the deleted row as JSON."""
    return changes.where(F.col("op") == S.DELETE).select(
        F.lit(application).alias("application"), "db", "table", F.to_json("row").alias("row_json")
    )


def delete_counts(changes: DataFrame) -> DataFrame:
    """Physical deletes and other changes per source table."""
    deleted = F.col("op") == S.DELETE
    return changes.groupBy("db", "table").agg(
        F.count_if(~deleted).alias("kept"), F.count_if(deleted).alias("deletes")
    )


def message(template: str, *columns: Column | str) -> Column:
    """Notification text from a %s template."""
    return F.format_string(template, *columns)


def reconcile(source: DataFrame, target: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, the side, and how many more `copies`.

    One aggregation over both sides: rows that occur millions of times collapse before
    the shuffle and come back as a number.
    """
    columns = source.columns
    both = source.withColumn("_sign", F.lit(1)).unionByName(target.select(*columns).withColumn("_sign", F.lit(-1)))
    surplus = both.groupBy(*columns).agg(F.sum("_sign").alias("_surplus")).where("_surplus <> 0")
    side = F.when(F.col("_surplus") > 0, "source_only").otherwise("target_only")
    return surplus.select(*columns, side.alias("side"), F.abs("_surplus").alias("copies"))


def table_digest(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Row count and an order-free checksum, per group if `by` is given.

    The hash passes over NULLs, so which columns are NULL goes in as well. A hot group
    costs one partial row per task.
    """
    flags = [F.col(c).isNull() for c in table.columns]
    digest = F.xxhash64(*table.columns, *flags).cast("decimal(38,0)")
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("checksum"))


def reconcile_digests(source: DataFrame, target: DataFrame, by: Sequence[str]) -> DataFrame:
    """Groups whose counts or checksums differ: the cheap first pass before reconcile."""
    left = table_digest(source, by).withColumnsRenamed({"rows": "source_rows", "checksum": "source_sum"})
    right = table_digest(target.select(*source.columns), by).withColumnsRenamed(
        {"rows": "target_rows", "checksum": "target_sum"}
    )
    same = F.col("source_rows").eqNullSafe(F.col("target_rows")) & F.col("source_sum").eqNullSafe(
        F.col("target_sum")
    )
    return left.join(right, list(by), "full").where(~same)
