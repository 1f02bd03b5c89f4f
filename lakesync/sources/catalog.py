"""Source catalog: tables, columns and keys of all databases in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.session import stored
from lakesync.sources.snapshot import jdbc_options, read_table

SYSTEM_SCHEMAS = ("information_schema", "mysql", "performance_schema", "sys")


def read_information_schema(spark: SparkSession, url: str, **options) -> tuple[DataFrame, DataFrame]:
    """The columns and statistics views of one instance."""
    return tuple(
        read_table(spark, jdbc_options(url, f"information_schema.{view}", **options))
        for view in ("columns", "statistics")
    )


def column_meta(columns: DataFrame, statistics: DataFrame) -> DataFrame:
    """COLUMN_META of all tables from the two information-schema views.

    The unique key is the union of the columns of all unique indexes.
    """
    columns, statistics = _lower(columns), _lower(statistics)
    at = ["table_schema", "table_name", "column_name"]
    unique = (
        statistics.where(F.col("non_unique").cast("int") == 0)
        .groupBy(*at)
        .agg(F.max(F.when(F.col("index_name") == "PRIMARY", 1).otherwise(0)).alias("pk"))
    )
    own = columns.where(~F.lower("table_schema").isin(*SYSTEM_SCHEMAS))
    return own.join(unique, at, "left").select(
        F.col("table_schema").alias("db"),
        F.col("table_name").alias("table"),
        F.col("column_name").alias("name"),
        F.upper("column_type").alias("type_name"),
        F.col("ordinal_position").cast("int").alias("ordinal"),
        F.col("character_maximum_length").try_cast("int").alias("length"),
        F.nullif("column_comment", F.lit("")).alias("comment"),
        (F.coalesce("pk", F.lit(0)) == 1).alias("is_pk"),
        F.col("pk").isNotNull().alias("is_uk"),
        F.contains(F.lower(F.coalesce("extra", F.lit(""))), F.lit("auto_increment")).alias("is_autoincrement"),
    )


def tables(meta: DataFrame, instance: str) -> DataFrame:
    """Catalog rows (instance, db, table)."""
    return meta.select(F.lit(instance).alias("instance"), "db", "table").distinct()


def table_keys(meta: DataFrame) -> DataFrame:
    """Key columns per table in column order: the primary key, else the unique columns.

    The lists are bounded by the number of columns of a table.
    """

    def names(flag: str):
        marked = F.when(F.col(flag), F.struct("ordinal", "name"))
        return F.transform(F.array_sort(F.collect_list(marked)), lambda x: x["name"])

    lists = meta.groupBy("db", "table").agg(
        names("is_pk").alias("pk"),
        names("is_uk").alias("uk"),
        F.max(F.coalesce("is_autoincrement", F.lit(False))).alias("autoincrement"),
    )
    keys = F.when(F.size("pk") > 0, F.col("pk")).otherwise(F.col("uk"))
    return lists.select("db", "table", "pk", keys.alias("keys"), "autoincrement")


def with_keys(routes: DataFrame, meta: DataFrame) -> DataFrame:
    """Routes with the key columns of their source table.

    Sharded sources with generated ids need the merge indexes in the key. The routes are written
    first: what the rules say of a catalog must not be inferred of the keys, read from the same one.
    """
    routes = stored(routes, "routes")
    keys = table_keys(meta).withColumnsRenamed({"db": "src_db", "table": "src_table"})
    joined = routes.join(keys, ["src_db", "src_table"], "left")
    merge = F.col("sharding") & F.coalesce("autoincrement", F.lit(False))
    return joined.withColumn("merge_fields", merge).drop("autoincrement")


def keyless(routes_with_keys: DataFrame, *, lake: bool) -> DataFrame:
    """Routes whose table has no usable key."""
    column = "pk" if lake else "keys"
    return routes_with_keys.where(F.coalesce(F.size(column), F.lit(0)) <= 0)


def _lower(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])
