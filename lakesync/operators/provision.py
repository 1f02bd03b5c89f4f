"""Target definitions of all routed tables as rows: one plan however many tables there are."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions import shards
from lakesync.functions.types import ddl_type

NO_SHARD_FUNCTION = "no_shard_function"
NO_SHARD_FIELD = "no_shard_field"
# Places of the columns that a target adds, among the ordinals of its source columns.
FIRST, LAST = -2, 1_000_000


def source_columns(meta: DataFrame, routes: DataFrame) -> DataFrame:
    """Columns of every routed table with its target; of sources that share a target the column comes once."""
    keyed = routes.select("src_db", "src_table", "dst_db", "dst_table", "sharding", "shard_count", "nodata").withColumnsRenamed(
        {"src_db": "db", "src_table": "table"}
    )
    rest = ["type_name", "ordinal", "comment", "is_pk", "is_autoincrement"]
    first = F.min_by(F.struct(*rest, "sharding", "shard_count", "nodata"), F.struct("db", "table"))
    return (
        meta.join(keyed, ["db", "table"])
        .groupBy("dst_db", "dst_table", "name")
        .agg(first.alias("c"))
        .select("dst_db", "dst_table", "name", "c.*")
    )


def _added(name: str, place: Column | int, kind: str, nullable: bool) -> Column:
    place = place if isinstance(place, Column) else F.lit(place)
    return F.struct(
        F.lit(name).alias("name"), place.cast("double").alias("place"), F.lit(kind).alias("type"), F.lit(nullable).alias("nullable")
    )


def lake_columns(meta: DataFrame, routes: DataFrame) -> DataFrame:
    """Columns of the lake targets: source names in front of sharded ones, keys required, sync time last."""
    columns = source_columns(meta, routes)
    own = columns.select(
        "dst_db", "dst_table", "name", F.col("ordinal").cast("double").alias("place"), ddl_type("type_name").alias("type"),
        (~F.col("is_pk")).alias("nullable"), "comment",
    )
    lineage = F.when(
        F.col("sharding"),
        F.array(_added(S.DB_NAME, FIRST, "string", False), _added(S.TABLE_NAME, FIRST + 1, "string", False)),
    )
    end = F.array(_added(S.SYNC_TS, LAST, "bigint", True))
    targets = columns.groupBy("dst_db", "dst_table").agg(F.max("sharding").alias("sharding"))
    added = targets.select("dst_db", "dst_table", F.inline(F.concat(F.coalesce(lineage, F.slice(end, 1, 0)), end)))
    return own.unionByName(added.withColumn("comment", F.lit(None).cast("string")))


def clone_columns(meta: DataFrame, routes: DataFrame) -> DataFrame:
    """Columns of the migration targets: merge indexes behind a generated column, part of the key of merged tables."""
    columns = source_columns(meta, routes)
    own = columns.select(
        "dst_db", "dst_table", "name", F.col("ordinal").cast("double").alias("place"), ddl_type("type_name").alias("type"),
        "is_pk",
    )
    keyed = columns.groupBy("dst_db", "dst_table").agg(
        F.max("sharding").alias("sharding"),
        F.max("is_pk").alias("keyed"),
        F.min(F.when(F.col("is_autoincrement"), F.col("ordinal"))).alias("generated"),
    )
    merged = keyed.where(F.col("sharding") & F.col("generated").isNotNull())
    indexes = F.array(
        _added(S.DB_INDEX, F.col("generated") + F.lit(0.25), "string", False),
        _added(S.TABLE_INDEX, F.col("generated") + F.lit(0.5), "string", False),
    )
    added = merged.select("dst_db", "dst_table", "keyed", F.inline(indexes)).drop("nullable")
    return own.unionByName(added.withColumnRenamed("keyed", "is_pk"))


def clone_targets(routes: DataFrame) -> DataFrame:
    """Tables that a migration creates: every shard of a re-sharded target."""
    count = F.coalesce("shard_count", F.lit(1))
    shard = F.when(count > 1, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.concat(F.lit("_"), i.cast("string"))))
    return (
        routes.select("dst_db", "dst_table", F.explode(F.coalesce(shard, F.array(F.lit("")))).alias("suffix"))
        .select("dst_db", F.concat("dst_table", "suffix").alias("dst_table"))
        .distinct()
    )


def shard_problems(meta: DataFrame, routes: DataFrame) -> DataFrame:
    """Re-sharded routes whose field has no shard function, or is not a column of the table; `nodata` ones need neither."""
    field = F.coalesce("shard_field", F.lit(shards.UID_FIELD))
    sharded = routes.where((F.col("shard_count") > 1) & ~F.col("nodata")).select(
        F.col("src_db").alias("db"), F.col("src_table").alias("table"), field.alias("name")
    )
    known = meta.select("db", "table", "name", F.lit(True).alias("there"))
    problem = F.when(~F.col("name").isin(shards.UID_FIELD, shards.ORDER_FIELD), NO_SHARD_FUNCTION).when(
        F.col("there").isNull(), NO_SHARD_FIELD
    )
    checked = sharded.join(known, ["db", "table", "name"], "left").withColumn("problem", problem)
    return checked.where("problem is not null").select("db", "table", F.col("name").alias("shard_field"), "problem")


def missing_targets(targets: DataFrame, existing: DataFrame) -> DataFrame:
    """Targets that a catalog listing (dst_db, dst_table) does not have yet."""
    return targets.join(existing, ["dst_db", "dst_table"], "left_anti")
