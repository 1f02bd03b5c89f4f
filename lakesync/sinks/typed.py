"""Typed keyed targets as Spark tables in buckets of the key.

A target holds its columns, typed and at top level, with the sync time and the positions that
decide later merges. Rows are bucketed and sorted by key, and each bucket is a partition as well:
a merge reads only the buckets that the net changes touch, joins them where they lie, without an
exchange, and replaces those partitions alone. Buckets whose net changes are large are sorted for the
join, others are not. Filters on columns and sync time reach the files.

Positions merge as "larger wins", so a batch may be merged again or late. Deleted keys stay as
markers with their values empty. New files of a bucket are complete before the old ones go; if the
driver dies between the two, `rebuild` fills the table from the state store again.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync import files, schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import fold
from lakesync.operators.typed import typed_rows
from lakesync.sinks.tables import bloom_options, create_namespace, quoted, text_literal

# Bookkeeping of a row, as in fold.STATE without the image.
_ORD = "struct<incremental: boolean, file_no: bigint, pos: bigint, row_no: int>"
POSITIONS = {"_anchor_op": "tinyint", "_anchor_ord": _ORD, "_image_ord": _ORD, "_last_op": "tinyint", "_last_ord": _ORD, "_last_ts": "bigint"}
BUCKET = "_bucket"
# Spark's setting for which partitions an overwrite replaces.
OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
# Bytes of a bucket's net changes that a task joins through a hash map, which cannot spill; more are sorted, which can.
HASHED_BYTES = 1 << 26
# Bytes of a field of such a row besides those of its texts.
FIELD_BYTES = 16


@dataclass
class TypedTable:
    """One target. `lineage` puts the source names in front of rows and key, as sharded lake targets need it."""

    spark: SparkSession
    db: str
    table: str
    columns: Sequence[ColumnSpec]
    profile: str = fold.LAKE
    lineage: bool = False
    buckets: int = 64
    location: str | None = None

    def __post_init__(self):
        self.keys = fold.key_columns(self.columns, lake=self.profile == fold.LAKE, sharded=self.lineage)
        source = {S.DB_NAME: "string", S.TABLE_NAME: "string"} if self.lineage else {}
        self.kinds = source | {c.name: c.spark_type() for c in self.columns} | {S.SYNC_TS: "bigint"}
        self.values = [c for c in self.kinds if c not in self.keys]
        self.name = f"{quoted(self.db)}.{quoted(self.table)}"

    def create(self) -> None:
        """Create the table if it is missing; over a location that has rows it finds them."""
        create_namespace(self.spark, self.db)
        fields = {**self.kinds, **POSITIONS, BUCKET: "int"}
        by = ", ".join(map(quoted, self.keys))
        options = ", ".join(f"'{k}' '{v}'" for k, v in bloom_options(self.keys).items())
        where = f" LOCATION {text_literal(self.location)}" if self.location else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({', '.join(f'{quoted(c)} {t}' for c, t in fields.items())}) USING parquet "
            f"OPTIONS ({options}) PARTITIONED BY ({quoted(BUCKET)}) CLUSTERED BY ({by}) SORTED BY ({by}) INTO {self.buckets} BUCKETS{where}"
        )
        if self.location and files.exists(self.spark, self.location):
            self.spark.catalog.recoverPartitions(self.name)

    def bucket(self) -> Column:
        """The partition of a key: the bucket in which Spark puts it."""
        return F.pmod(F.hash(*self.keys), F.lit(self.buckets)).cast("int")

    def typed(self, routed: DataFrame, f_ts: Column | int) -> DataFrame:
        """Routed changes of this target, typed, with position and sync time; `_reason` rows are left out."""
        stamp = f_ts if isinstance(f_ts, Column) else F.lit(f_ts)
        typed = typed_rows(routed.where(F.col("op") != S.DDL), self.columns, carry=S.bookkeeping(), lineage=self.lineage, f_ts=stamp)
        return typed.where(F.col(S.REASON).isNull()).drop(S.REASON)

    def net(self, typed: DataFrame) -> DataFrame:
        """Net changes of typed changes."""
        return fold.fold(typed, self.keys, F.struct(*self.values), F.col(S.SYNC_TS))

    def states(self, routed: DataFrame, f_ts: Column | int) -> DataFrame:
        """Net changes of routed changes of this target, typed, with `_reason` rows left out."""
        return self.net(self.typed(routed, f_ts))

    def _joined(self, states: DataFrame, touched: Sequence[int] | None, hashed: bool | None) -> DataFrame:
        """Keys with `_was` and `_now`, the row and its positions before and after net changes, and `_hit`: whether there is one.

        `hashed`: whether the net changes of every bucket fit a hash map (see `fits`), looked up if None.
        """
        hashed = self.fits(self.sizes(states)) if hashed is None else hashed
        old = self.spark.table(self.name)
        if touched is not None:
            old = old.where(F.col(BUCKET).isin(*touched))
        names = {c: f"_new_{c}" for c in (*fold.STATE, "last_ts")}
        net = states.select(*self.keys, *[F.col(c).alias(n) for c, n in names.items()]).hint("shuffle_hash" if hashed else "merge")
        joined = old.drop(BUCKET).join(net, self.keys, "full")

        def pick(kind: str, new: Column, old: str) -> Column:
            was, now = F.col(f"_{kind}_ord"), F.col(f"_new_{kind}_ord")
            later = now.isNotNull() & (was.isNull() | (now > was))
            return F.when(later, new).otherwise(F.col(old)).alias(old)

        values = [pick("image", F.col("_new_image")[c], c) for c in self.values]
        positions = [pick(c.split("_")[1], F.col(f"_new{c}"), c) for c in POSITIONS]
        held = [*self.values, *POSITIONS]
        return joined.select(
            *self.keys, F.struct(*held).alias("_was"), F.struct(*values, *positions).alias("_now"), F.col("_new_last_ord").isNotNull().alias("_hit")
        )

    def _exists(self, row: str) -> Column:
        """Whether the row of a struct with positions is in the target."""
        last, anchor = F.col(f"{row}._last_op"), F.col(f"{row}._anchor_op")
        there = last != S.DELETE if self.profile == fold.LAKE else anchor == S.INSERT
        return F.coalesce(there, F.lit(False))

    def merged(self, states: DataFrame, touched: Sequence[int] | None = None, hashed: bool | None = None) -> DataFrame:
        """Rows of the touched buckets after net changes, one of which a key has at most; all buckets if None."""
        joined = self._joined(states, touched, hashed)
        # A deleted lake row keeps its key and positions only.
        kept = [F.when(self._exists("_now"), F.col("_now")[c]).alias(c) if self.profile == fold.LAKE else F.col("_now")[c].alias(c) for c in self.values]
        columns = {c: k for c, k in zip(self.values, kept, strict=True)}
        return joined.select(*[columns.get(c, F.col(c)) for c in self.kinds], *[F.col("_now")[c].alias(c) for c in POSITIONS], self.bucket().alias(BUCKET))

    def differences(self, states: DataFrame, touched: Sequence[int] | None = None, hashed: bool | None = None) -> DataFrame:
        """Keys that net changes alter, with the row `before` and `after`, null where there is none; ask before `merge`."""

        def row(side: str) -> Column:
            return F.when(self._exists(side), F.struct(*[F.col(side)[c].alias(c) for c in self.values]))

        found = self._joined(states, touched, hashed).where("_hit")
        return found.select(*self.keys, row("_was").alias("before"), row("_now").alias("after")).where(~F.col("before").eqNullSafe(F.col("after")))

    def sizes(self, states: DataFrame) -> dict[int, int]:
        """Bytes, about, that the net changes of each bucket have as rows; a number for each bucket at most."""
        texts = [c if c in self.keys else f"image.{c}" for c, kind in self.kinds.items() if kind in ("string", "binary")]
        fixed = FIELD_BYTES * (len(self.kinds) + 5 * len(POSITIONS))
        size = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in texts), F.lit(fixed).cast("bigint"))
        return dict(map(tuple, states.groupBy(self.bucket().alias("bucket")).agg(F.sum(size)).collect()))

    def fits(self, sizes: dict[int, int]) -> bool:
        """Whether a task may hold the net changes of any bucket in a hash map."""
        return max(sizes.values(), default=0) <= HASHED_BYTES

    def touched(self, states: DataFrame) -> list[int]:
        """Buckets of the keys of net changes, a number for each at most."""
        return sorted(r[0] for r in states.select(self.bucket()).distinct().collect())

    def merge(self, states: DataFrame, sizes: dict[int, int] | None = None) -> list[int]:
        """Apply stored or cached net changes; returns the buckets that were written. `sizes` are looked up if None."""
        sizes = self.sizes(states) if sizes is None else sizes
        touched = sorted(sizes)
        if touched:
            self._put(self.merged(states, touched, self.fits(sizes)))
        return touched

    def rebuild(self, states: DataFrame) -> None:
        """Fill the table from net changes of all time (see StateStore.states), whatever it holds."""
        self._put(self.merged(states, hashed=False))

    def _put(self, rows: DataFrame) -> None:
        # A write option does not reach the check of what an insert reads and replaces; the setting does.
        before = self.spark.conf.get(OVERWRITE, None)
        self.spark.conf.set(OVERWRITE, "dynamic")
        try:
            rows.write.insertInto(self.name, overwrite=True)
        finally:
            if before is None:
                self.spark.conf.unset(OVERWRITE)
            else:
                self.spark.conf.set(OVERWRITE, before)

    def current(self, since: int | None = None) -> DataFrame:
        """Rows that exist; those synced after a time, if one is given."""
        rows = self._existing(fold.UPSERT)
        if since is not None:
            rows = rows.where(F.col(S.SYNC_TS) > since)
        return rows.select(*self.kinds)

    def deleted(self, since: int) -> DataFrame:
        """Keys that were deleted after a sync time."""
        return self._existing(fold.REMOVE).where(F.col("_last_ts") > since).select(*self.keys)

    def _existing(self, action: str) -> DataFrame:
        op = "_last_op" if self.profile == fold.LAKE else "_anchor_op"
        wanted = F.col(op) == S.DELETE if action == fold.REMOVE else (
            F.col(op) != S.DELETE if self.profile == fold.LAKE else F.col(op) == S.INSERT
        )
        return self.spark.table(self.name).where(wanted)
