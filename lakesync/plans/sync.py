"""From envelopes to state rows: the work both jobs share, batch or micro-batch.

Lake sync folds with the lake profile and keys sharded targets by their source names;
migration re-shards, adds merge indexes and folds with the migration profile.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards, wire
from lakesync.functions.types import ColumnSpec
from lakesync.operators import decode, fold, quality, routes as R
from lakesync.operators.reshard import BAD_SHARD_KEY, NO_INDEX
from lakesync.operators.typed import MISSING_KEY, typed_rows
from lakesync.sinks.store import KEYS

# Columns a routed change gains from its route.
ROUTED = ("dst_db", "dst_table", "sharding", "shard_count", "shard_field", "keys", "merge_fields")


def typed_changes(
    envelopes: DataFrame,
    columns: Sequence[ColumnSpec],
    *,
    routes: DataFrame | None = None,
    split_keys: bool = True,
    logs: DataFrame | None = None,
    **typed_options,
) -> DataFrame:
    """Typed changes of one target, with bookkeeping columns and `_reason`.

    The row is typed before any shuffle, so only the columns of the target travel. `logs`
    orders the logs of an instance (see decode.continued).
    """
    changes = decode.decode(envelopes)
    if logs is not None:
        changes = decode.continued(changes, logs)
    if split_keys:
        changes = decode.split_key_updates(changes, variant_key(fold.row_key(columns)))
    if routes is not None:
        changes = R.route(changes, routes)
    rows = changes.where(F.col("op") != S.DDL)
    return typed_rows(rows, columns, carry=S.bookkeeping(), **typed_options)


def current_rows(
    envelopes: DataFrame,
    columns: Sequence[ColumnSpec],
    profile: str,
    *,
    routes: DataFrame | None = None,
    target: DataFrame | None = None,
    **typed_options,
) -> DataFrame:
    """Current rows of one typed target after a feed, on top of an existing target if given."""
    keys = fold.key_columns(
        columns, lake=profile == fold.LAKE, sharded=bool(typed_options.get("lineage"))
    )
    good = quality.accepted(typed_changes(envelopes, columns, routes=routes, **typed_options))
    states = fold.fold(good, keys)
    if target is None:
        return fold.current(states, keys, profile)
    return fold.apply(target, states, keys, profile)


def variant_key(names: Sequence[str]):
    """Key of a VARIANT row for a known table, as an array of texts."""

    def key_of(row: Column) -> Column:
        return F.array(*[F.try_variant_get(row, wire.field_path(n), "string") for n in names])

    return key_of


# Names of key columns that get a path of their own; a path that is made for each row is parsed for each row.
KNOWN_NAMES = 32


def key_names(routes: DataFrame) -> list[str]:
    """Names that the keys of routes use, if they are few; else none."""
    names = routes.select(F.explode("keys").alias("name")).distinct().limit(KNOWN_NAMES + 1).collect()
    return sorted(r["name"] for r in names) if len(names) <= KNOWN_NAMES else []


def routed_key(names: Column, known: Sequence[str] = ()):
    """Key of a VARIANT row whose key columns come with its route; `known` names are read by constant paths."""

    def key_of(row: Column) -> Column:
        return F.transform(names, lambda n: named_field(row, n, known))

    return key_of


def named_field(row: Column, name: Column, known: Sequence[str] = ()) -> Column:
    """Text of the field of a VARIANT row whose name is a column."""
    single = F.concat(F.lit("$['"), name, F.lit("']"))
    path = F.when(F.contains(name, F.lit("'")), F.concat(F.lit('$["'), name, F.lit('"]'))).otherwise(single)
    found = F.try_variant_get(row, path, "string")
    for one in reversed(known):
        found = F.when(name == one, F.try_variant_get(row, wire.field_path(one), "string")).otherwise(found)
    return found


def target_shard(row: Column) -> Column:
    """Number of the shard a row of a re-sharded target belongs to, 0 where there is one; NULL if its field tells none."""
    text = named_field(row, F.col("shard_field"), (shards.UID_FIELD, shards.ORDER_FIELD))
    return (
        F.when(F.coalesce("shard_count", F.lit(1)) <= 1, F.lit(0))
        .when(F.col("shard_field") == shards.UID_FIELD, shards.shard_of_uid(text, F.col("shard_count")))
        .when(F.col("shard_field") == shards.ORDER_FIELD, shards.shard_of_order(text, F.col("shard_count")))
    )


def placed_key(names: Column, known: Sequence[str] = ()):
    """Key of a VARIANT row with the shard it belongs to: an update that changes either moves the row."""
    key_of = routed_key(names, known)
    return lambda row: F.concat(key_of(row), F.array(target_shard(row).cast("string")))


def routed_changes(
    envelopes: DataFrame,
    routes: DataFrame,
    *,
    value: str = "value",
    check_size: bool = True,
    split_keys: bool = True,
    logs: DataFrame | None = None,
    known: Sequence[str] | None = None,
) -> DataFrame:
    """Decoded changes of all tables with route, `key` and `_reason`.

    An update that changes the key, or the shard of a re-sharded target, becomes a delete
    where the row was and an insert where it is. `logs` orders the logs of an instance
    (see decode.continued). `known` are the names of key columns (see key_names), looked up if None.
    """
    known = key_names(routes) if known is None else known
    changes = decode.decode(envelopes, value)
    if logs is not None:
        changes = decode.continued(changes, logs)
    changes = R.route(changes, routes, check_size)
    key_of = routed_key(F.col("keys"), known)
    if split_keys:
        changes = decode.split_key_updates(changes, placed_key(F.col("keys"), known))
    is_row = F.col("op") != S.DDL
    changes = changes.withColumn("key", F.when(is_row, key_of(F.col("row"))))
    absent = is_row & (
        F.col("key").isNull() | (F.size("key") <= 0) | F.exists("key", lambda k: k.isNull())
    )
    reason = F.coalesce(S.REASON, F.when(absent, F.lit(MISSING_KEY)))
    return changes.withColumn(S.REASON, reason).drop("before")


def lake_targets(routed: DataFrame, instance_key: bool = False) -> DataFrame:
    """Sharded targets are keyed by source names and key.

    `instance_key` puts the instance in front, for targets that several instances feed: their
    positions have no common order, so their rows must not share a key.
    """
    source = F.array("instance", "db", "table") if instance_key else F.array("db", "table")
    full = F.concat(source, F.col("key"))
    return routed.withColumn("key", F.when(F.col("sharding"), full).otherwise(F.col("key")))


def migration_targets(routed: DataFrame) -> DataFrame:
    """Re-shard, extend keys by the merge indexes, set aside rows without either."""
    shard = target_shard(F.col("row"))
    indexes = F.array(shards.database_index("db"), shards.table_index("table"))
    is_row = F.col("op") != S.DDL
    merges = F.col("merge_fields") & is_row
    out = routed.withColumn("_shard", F.when(is_row, shard))
    out = out.withColumn(
        S.REASON,
        F.coalesce(
            S.REASON,
            F.when(is_row & F.col("_shard").isNull(), F.lit(BAD_SHARD_KEY)),
            F.when(merges & F.exists(indexes, lambda i: i.isNull()), F.lit(NO_INDEX)),
        ),
    )
    sharded = (F.col("shard_count") > 1) & is_row
    return out.withColumns(
        {
            "dst_table": F.when(sharded, F.concat_ws("_", "dst_table", "_shard")).otherwise(F.col("dst_table")),
            "key": F.when(merges, F.concat("key", indexes)).otherwise(F.col("key")),
        }
    ).drop("_shard")


def targets(routed: DataFrame, profile: str, instance_key: bool = False) -> DataFrame:
    return lake_targets(routed, instance_key) if profile == fold.LAKE else migration_targets(routed)


def states(targeted: DataFrame, f_ts: Column | int) -> DataFrame:
    """State rows of all targets of a batch, one aggregation for every table."""
    stamp = f_ts if isinstance(f_ts, Column) else F.lit(f_ts)
    rows = targeted.where(F.col(S.REASON).isNull() & (F.col("op") != S.DDL))
    image = F.struct("row", "db", "table", stamp.cast("bigint").alias("f_ts"))
    rows = rows.select(*KEYS, *S.bookkeeping(), image.alias("_row"), stamp.cast("bigint").alias("_stamp"))
    return fold.fold(rows, KEYS, F.col("_row"), F.col("_stamp"))
