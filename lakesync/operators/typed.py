"""VARIANT rows to typed target rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards, wire
from lakesync.functions.types import ColumnSpec
from lakesync.operators.fold import row_key

BAD_CAST = "bad_cast"
MISSING_KEY = "missing_key"


def typed_rows(
    changes: DataFrame,
    columns: Sequence[ColumnSpec],
    *,
    carry: Sequence[str | Column] = (),
    lineage: bool = False,
    merge_indexes: bool = False,
    f_ts: Column | int | None = None,
    target_zone: str = "UTC",
    shift: int = 0,
    widen_unsigned: bool = False,
) -> DataFrame:
    """Project the row of each change into the columns of its target.

    Absent fields become NULL. A value that does not fit its type, or a key or
    required column without a value, sets `_reason`. `lineage` puts the source names
    in front, `merge_indexes` appends their shard indexes, `f_ts` the sync time (a
    literal for one value per batch).
    """
    row = F.col("row")
    clocks = {c.name: f"_number_{i}" for i, c in enumerate(columns) if wire.read_as_number(c)}
    numbers = {n: wire.number_field(row, name) for name, n in clocks.items()}
    fields = {
        f"_value_{i}": wire.typed_field(
            row, c, target_zone, shift, widen_unsigned, F.col(clocks[c.name]) if c.name in clocks else None
        )
        for i, c in enumerate(columns)
    }
    # Each step reads the results of the one before, so a field is converted once for
    # its value and its check together.
    typed = changes.withColumns(numbers).withColumns(fields) if numbers else changes.withColumns(fields)
    values = {c.name: F.col(f"_value_{i}") for i, c in enumerate(columns)}
    bad = _any([unfit(row, c, values[c.name]) for c in columns])
    key = set(row_key(columns))
    absent = _any([values[c.name].isNull() for c in columns if c.name in key or c.required])

    out = [c if isinstance(c, Column) else F.col(c) for c in carry]
    if lineage:
        out += [F.col("db").alias(S.DB_NAME), F.col("table").alias(S.TABLE_NAME)]
    out += [v.alias(name) for name, v in values.items()]
    if merge_indexes:
        out += [shards.database_index("db").alias(S.DB_INDEX), shards.table_index("table").alias(S.TABLE_INDEX)]
    if f_ts is not None:
        stamp = f_ts if isinstance(f_ts, Column) else F.lit(f_ts)
        out.append(stamp.cast("bigint").alias(S.SYNC_TS))
    earlier = F.col(S.REASON) if S.REASON in changes.columns else F.lit(None).cast("string")
    reason = F.coalesce(earlier, F.when(bad, BAD_CAST).when(absent, MISSING_KEY))
    return S.evaluated_once(typed, [*out, reason.alias(S.REASON)])


def rejected(changes: DataFrame, columns: Sequence[ColumnSpec], **options) -> DataFrame:
    """Changes whose row does not fit its target, whole, with the reason in front."""
    kept = [c for c in S.QUARANTINE_COLUMNS if c in changes.columns]
    typed = typed_rows(changes, columns, carry=[F.struct(*kept).alias("_change")], **options)
    bad = typed.where(F.col(S.REASON).isNotNull())
    return bad.select(F.col(S.REASON).alias("reason"), "_change.*")


def sync_time() -> Column:
    """Wall-clock milliseconds, one value per query or micro-batch."""
    return F.unix_millis(F.current_timestamp())


def unfit(row: Column, spec: ColumnSpec, value: Column) -> Column:
    """Whether the row holds something for the column that did not become a value."""
    kept = value.isNotNull() | ~wire.present(row, spec.name)
    if spec.wire_type or spec.spark_type() == "timestamp_ntz":
        # A zero date is the source's way to write "no value".
        text = F.try_variant_get(row, wire.field_path(spec.name), "string")
        kept = kept | F.startswith(text, F.lit("0000-00-00"))
    return ~F.coalesce(kept, F.lit(False))


def _any(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))
