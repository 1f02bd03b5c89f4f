"""Folding changes per key into current state.

`fold` reduces any number of changes of a key to one state row, with partial
aggregation before the shuffle, so a key that owns a third of the feed travels as
one row per map task. State rows merge in any order and any number of times
(larger position wins), which makes batches, replays and late rows harmless.

Two ways to read a state:
  lake       inserts and updates both write the row, a delete removes it
  migration  an update only changes a row that exists
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec

LAKE = "lake"
MIGRATION = "migration"

STATE = ("anchor_op", "anchor_ord", "image", "image_ord", "last_op", "last_ord")

UPSERT = "upsert"
UPDATE = "update"
REMOVE = "delete"


def key_columns(columns: Sequence[ColumnSpec], *, lake: bool, sharded: bool = False) -> list[str]:
    """Key of a target table.

    Lake tables need a primary key; migration also takes the union of the columns of
    all unique indexes. Sharded lake targets put the source names in front.
    """
    keys = row_key(columns) if not lake else [c.name for c in columns if c.is_pk]
    if not keys:
        raise ValueError("table has no primary key" + ("" if lake else " or unique key"))
    return [S.DB_NAME, S.TABLE_NAME, *keys] if lake and sharded else keys


def row_key(columns: Sequence[ColumnSpec]) -> list[str]:
    """What tells the rows of a source table apart: its primary key, else the columns of its unique indexes."""
    return [c.name for c in columns if c.is_pk] or [c.name for c in columns if c.is_uk]


def fold(
    changes: DataFrame, keys: Sequence[str], image: Column | None = None, stamp: Column | None = None
) -> DataFrame:
    """Changes (see schemas.bookkeeping) to one state row per key.

    `image` is the row to keep; by default a struct of all columns that are neither
    keys nor bookkeeping. `stamp` is the sync time of a change; the last one of any kind,
    deletes too, is kept as `last_ts`.
    """
    if image is None:
        image = F.struct(*value_columns(changes, keys))
    op, at = F.col(S.CHANGE_OP), F.col(S.CHANGE_ORD)
    rows = changes.where(op.isin(S.INSERT, S.UPDATE_AFTER, S.DELETE))
    stamped = [] if stamp is None else [stamp.cast("bigint").alias("_ts")]
    rows = rows.select(*keys, op.alias("_op"), image.alias("_image"), at.alias("_ord"), *stamped)
    anchors = F.col("_op").isin(S.INSERT, S.DELETE)
    images = F.col("_op").isin(S.INSERT, S.UPDATE_AFTER)
    return rows.groupBy(*keys).agg(
        F.max_by(F.when(anchors, F.col("_op")), F.when(anchors, F.col("_ord"))).alias("anchor_op"),
        F.max(F.when(anchors, F.col("_ord"))).alias("anchor_ord"),
        F.max_by(F.when(images, F.col("_image")), F.when(images, F.col("_ord"))).alias("image"),
        F.max(F.when(images, F.col("_ord"))).alias("image_ord"),
        F.max_by("_op", "_ord").alias("last_op"),
        F.max("_ord").alias("last_ord"),
        *([] if stamp is None else [F.max_by("_ts", "_ord").alias("last_ts")]),
    )


def merge(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Several state rows per key to one."""
    return states.groupBy(*keys).agg(
        F.max_by("anchor_op", "anchor_ord").alias("anchor_op"),
        F.max("anchor_ord").alias("anchor_ord"),
        F.max_by("image", "image_ord").alias("image"),
        F.max("image_ord").alias("image_ord"),
        F.max_by("last_op", "last_ord").alias("last_op"),
        F.max("last_ord").alias("last_ord"),
        *([F.max_by("last_ts", "last_ord").alias("last_ts")] if "last_ts" in states.columns else []),
    )


def seed(target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of an existing keyed table as state, below every change."""
    values = [c for c in target.columns if c not in keys]
    return target.select(
        *keys,
        F.lit(S.INSERT).cast("tinyint").alias("anchor_op"),
        S.lowest_order().alias("anchor_ord"),
        F.struct(*values).alias("image"),
        S.lowest_order().alias("image_ord"),
        F.lit(S.INSERT).cast("tinyint").alias("last_op"),
        S.lowest_order().alias("last_ord"),
    )


def action(profile: str) -> Column:
    """What a state row does to its target."""
    if profile == LAKE:
        return F.when(F.col("last_op") == S.DELETE, REMOVE).otherwise(UPSERT)
    if profile == MIGRATION:
        return (
            F.when(F.col("anchor_op") == S.DELETE, REMOVE)
            .when(F.col("anchor_op") == S.INSERT, UPSERT)
            .otherwise(UPDATE)
        )
    raise ValueError(f"unknown profile {profile!r}")


def current(states: DataFrame, keys: Sequence[str], profile: str) -> DataFrame:
    """Rows that exist after all folded changes, nothing else being in the target."""
    return states.where(action(profile) == UPSERT).select(*keys, "image.*")


def apply(target: DataFrame, states: DataFrame, keys: Sequence[str], profile: str) -> DataFrame:
    """Target table after the net changes, one row per key in both inputs.

    One full join: target and net changes shuffle once on the key (a bucketed target
    not at all) and the net changes are computed once.
    """
    values = [c for c in target.columns if c not in keys]
    old = target.select(*keys, F.struct(*values).alias("_old"))
    net = states.select(*keys, action(profile).alias("_action"), _like(values).alias("_new"))
    untouched = F.col("_action").isNull()
    keeps = untouched | (F.col("_action") == UPSERT) | ((F.col("_action") == UPDATE) & F.col("_old").isNotNull())
    row = F.when(untouched, F.col("_old")).otherwise(F.col("_new"))
    joined = old.join(net, list(keys), "full").where(keeps)
    return joined.select(*keys, row.alias("_row")).select(*keys, *[F.col("_row")[c].alias(c) for c in values])


def apply_stored(target: DataFrame, states: DataFrame, keys: Sequence[str], profile: str) -> DataFrame:
    """The same for states read from storage.

    The size of stored states is known when the query is planned, so a small batch is
    broadcast and the target does not move at all. The states are read twice.
    """
    values = [c for c in target.columns if c not in keys]
    net = states.select(*keys, action(profile).alias("_action"), "image")
    touched = target.join(net, list(keys), "left")
    updated = F.col("_action") == UPDATE
    kept = touched.where(F.col("_action").isNull() | updated).select(
        *keys, *[F.when(updated, F.col("image")[c]).otherwise(F.col(c)).alias(c) for c in values]
    )
    written = net.where(F.col("_action") == UPSERT).select(*keys, *[F.col("image")[c].alias(c) for c in values])
    return kept.unionByName(written)


def net_changes(states: DataFrame, keys: Sequence[str], profile: str) -> DataFrame:
    """Net change set of a batch: keys, values and the action to take."""
    return states.select(*keys, action(profile).alias("action"), "image.*")


def _like(values: Sequence[str]) -> Column:
    """The image with its fields in the order of the target."""
    return F.struct(*[F.col("image")[c].alias(c) for c in values])


def value_columns(changes: DataFrame, keys: Sequence[str]) -> list[str]:
    skip = {*keys, S.CHANGE_OP, S.CHANGE_ORD, S.REASON}
    return [c for c in changes.columns if c not in skip]


def key_violations(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, or hold a NULL."""
    nulls = [F.col(k).isNull() for k in keys]
    has_null = nulls[0]
    for n in nulls[1:]:
        has_null = has_null | n
    counted = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return counted.where((F.col("rows") > 1) | has_null)
