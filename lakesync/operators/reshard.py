"""Lineage columns, merge indexes and re-sharding of routed rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards
from lakesync.functions.types import ColumnSpec

BAD_SHARD_KEY = "bad_shard_key"
NO_INDEX = "no_shard_index"


def with_lineage(rows: DataFrame) -> DataFrame:
    """Source database and table in front, so shards merge without key clashes."""
    rest = [c for c in rows.columns if c not in ("db", "table")]
    return rows.select(F.col("db").alias(S.DB_NAME), F.col("table").alias(S.TABLE_NAME), *rest)


def with_merge_indexes(rows: DataFrame) -> DataFrame:
    """Merge indexes of the source names; a sharded source without digits is marked."""
    out = rows.withColumns(
        {S.DB_INDEX: shards.database_index("db"), S.TABLE_INDEX: shards.table_index("table")}
    )
    absent = F.col(S.DB_INDEX).isNull() | F.col(S.TABLE_INDEX).isNull()
    reason = F.col("_reason") if "_reason" in rows.columns else F.lit(None).cast("string")
    return out.withColumn("_reason", F.coalesce(reason, F.when(absent, F.lit(NO_INDEX))))


def with_shard(rows: DataFrame, field: str, count: str | int, *, by: str | None = None) -> DataFrame:
    """Target shard number in `shard`; rows whose field gives none are marked.

    `by` is "uid" or "order"; by default the two fixed field names decide.
    """
    kind = by or {shards.UID_FIELD: "uid", shards.ORDER_FIELD: "order"}.get(field)
    if kind not in ("uid", "order"):
        raise ValueError(f"no shard function for field {field!r}")
    total = shards.shard_count(count)
    if total == 1:
        shard = F.lit(0)
    elif kind == "uid":
        shard = shards.shard_of_uid(F.col(field), total)
    else:
        shard = shards.shard_of_order(F.col(field), total)
    reason = F.col("_reason") if "_reason" in rows.columns else F.lit(None).cast("string")
    return rows.withColumn("shard", shard).withColumn(
        "_reason", F.coalesce(reason, F.when(F.col("shard").isNull(), F.lit(BAD_SHARD_KEY)))
    )


def moves(
    rows: DataFrame, table: str, field: str, old: str | int, new: str | int, *, by: str | None = None, file: str, pos: int
) -> DataFrame:
    """Changes that bring a target from `old` to `new` shards: (dst_table, op, file, pos) and the columns of its rows.

    Only rows whose shard differs move, each as a delete where it was and an insert where it
    goes, at one log position: later changes of the row win over both. The others are not touched.
    A row whose field gives no shard has a `_reason` and goes nowhere.
    """

    def place(shard: Column, count: str | int) -> Column:
        return F.lit(table) if shards.shard_count(count) == 1 else F.concat(F.lit(f"{table}_"), shard.cast("string"))

    was = with_shard(rows.select(F.struct(*rows.columns).alias("_row"), F.col(field)), field, old, by=by)
    now = with_shard(was.withColumnRenamed("shard", "_was"), field, new, by=by)
    known = now.select("_row", "_reason", place(F.col("_was"), old).alias("_from"), place(F.col("shard"), new).alias("_to"))
    parts = F.array(
        F.struct(F.col("_from").alias("dst_table"), F.lit(S.DELETE).cast("tinyint").alias("op")),
        F.struct(F.col("_to").alias("dst_table"), F.lit(S.INSERT).cast("tinyint").alias("op")),
    )
    bad = F.array(F.struct(F.lit(None).cast("string").alias("dst_table"), F.lit(S.INSERT).cast("tinyint").alias("op")))
    some = known.where("_reason is not null or _from <> _to")
    split = some.select("_row", "_reason", F.explode(F.when(F.col("_reason").isNull(), parts).otherwise(bad)).alias("_part"))
    return split.select("_part.*", F.lit(file).alias("file"), F.lit(pos).cast("bigint").alias("pos"), "_reason", "_row.*")


def shard_table(table: str, shard: int | None, count: str | int | None) -> str:
    return table if shards.shard_count(count) == 1 else f"{table}_{shard}"


def shard_tables(table: str, count: str | int | None) -> list[str]:
    """Names of all shards of a target table."""
    return [shard_table(table, i, count) for i in range(shards.shard_count(count))]


def check_shard_field(columns: Sequence[ColumnSpec], field: str | None, count: str | int | None) -> None:
    """A re-sharded target needs a field with a shard function, and the field must exist."""
    if shards.shard_count(count) == 1:
        return
    name = field or shards.UID_FIELD
    if name not in (shards.UID_FIELD, shards.ORDER_FIELD):
        raise ValueError(f"no shard function for field {name!r}")
    if name not in {c.name for c in columns}:
        raise ValueError(f"shard field {name!r} is not a column")


def widened_for_merge(columns: Sequence[ColumnSpec], sharding: bool) -> list[ColumnSpec]:
    """Add the merge indexes behind an auto-increment column and put them into the key.

    Tables without such a column have keys that are unique across shards already.
    """
    at = next((i for i, c in enumerate(columns) if c.is_autoincrement), None)
    if not sharding or at is None:
        return list(columns)
    keyed = any(c.is_pk for c in columns)
    extra = [
        ColumnSpec(name, "VARCHAR", is_pk=keyed, length=50, required=True, default="")
        for name in (S.DB_INDEX, S.TABLE_INDEX)
    ]
    return [*columns[: at + 1], *extra, *columns[at + 1 :]]


def has_merge_indexes(columns: Sequence[ColumnSpec]) -> bool:
    return {S.DB_INDEX, S.TABLE_INDEX} <= {c.name for c in columns}


def without_autoincrement(columns: Sequence[ColumnSpec]) -> list[ColumnSpec]:
    """The target of a merge takes its ids from the sources."""
    return [replace(c, is_autoincrement=False) for c in columns]
