"""Target provisioning, keyed merge on capable catalogs, key deletes, write layout."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import reshard
from lakesync.sources.chunks import chunk_bounds, chunk_of

# Table properties of a lake target on a row-level table format.
ROW_LEVEL_PROPERTIES = {
    "format-version": "2",
    "write.upsert.enabled": "true",
    "write.metadata.previous-versions-max": "3",
    "write.metadata.delete-after-commit.enabled": "true",
    "commit.manifest.min-count-to-merge": "30",
    "history.expire.max-snapshot-age-ms": "7200000",
}

# Rows that a task sorts for one file, so that its memory does not grow with the table.
FILE_ROWS = 4_000_000


def target_schema(
    columns: Sequence[ColumnSpec], *, sharded: bool = False, sync_time: bool = True, widen_unsigned: bool = False
) -> ST.StructType:
    """Typed schema of a target: lineage in front, keys required, comments kept, sync time last."""
    fields = []
    if sharded:
        fields += [
            _field(S.DB_NAME, "string", False, "source database"),
            _field(S.TABLE_NAME, "string", False, "source table"),
        ]
    fields += [
        _field(c.name, c.spark_type(widen_unsigned), not (c.is_pk or c.required), c.comment) for c in columns
    ]
    if sync_time:
        fields.append(_field(S.SYNC_TS, "bigint", True, None))
    return ST.StructType(fields)


def create_namespace(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {quoted(name)}")


def exists(spark: SparkSession, namespace: str, table: str) -> bool:
    return spark.catalog.tableExists(f"{quoted(namespace)}.{quoted(table)}")


def bloom_options(columns: Iterable[str]) -> dict[str, str]:
    """Parquet point-lookup filters on some columns."""
    return {f"parquet.bloom.filter.enabled#{c}": "true" for c in columns}


def create_table(
    spark: SparkSession,
    namespace: str,
    table: str,
    schema: ST.StructType,
    *,
    using: str = "parquet",
    bloom: Iterable[str] = (S.SYNC_TS,),
    keys: Sequence[str] = (),
    buckets: int = 0,
) -> bool:
    """Create an empty target if missing; returns whether it was created.

    `buckets` co-locates a parquet target on its key, so later joins and folds on the
    key read it without a shuffle.
    """
    if exists(spark, namespace, table):
        return False
    create_namespace(spark, namespace)
    name = f"{quoted(namespace)}.{quoted(table)}"
    indexed = [f.name for f in schema.fields if f.name in set(bloom)]
    lines = []
    for f in schema.fields:
        comment = (f.metadata or {}).get("comment")
        lines.append(
            f"{quoted(f.name)} {f.dataType.simpleString()}"
            + ("" if f.nullable else " NOT NULL")
            + (f" COMMENT {text_literal(comment)}" if comment else "")
        )
    sql = f"CREATE TABLE {name} ({', '.join(lines)}) USING {using}"
    if using == "parquet":
        options = bloom_options(indexed)
        if options:
            sql += " OPTIONS (" + ", ".join(f"'{k}' '{v}'" for k, v in options.items()) + ")"
        if buckets and keys:
            by = ", ".join(quoted(k) for k in keys)
            sql += f" CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS"
    else:
        props = ROW_LEVEL_PROPERTIES | {f"write.parquet.bloom-filter-enabled.column.{c}": "true" for c in indexed}
        sql += " TBLPROPERTIES (" + ", ".join(f"'{k}' = '{v}'" for k, v in props.items()) + ")"
    spark.sql(sql)
    return True


def create_clones(
    spark: SparkSession, namespace: str, table: str, columns: Sequence[ColumnSpec], count: str | int | None,
    *, sharding: bool = True, shard_field: str | None = None, nodata: bool = False, **options,
) -> list[str]:
    """Create the target of a migration, all its shards, from the source definition."""
    if not any(c.is_pk or c.is_uk for c in columns):
        raise ValueError(f"table {namespace}.{table} has no primary key or unique key")
    if not nodata and sharding:
        reshard.check_shard_field(columns, shard_field, count)
    schema = target_schema(reshard.widened_for_merge(columns, sharding), sync_time=False)
    names = reshard.shard_tables(table, count) if sharding else [table]
    return [n for n in names if create_table(spark, namespace, n, schema, **options)]


def merge_into(net: DataFrame, target: str, keys: Sequence[str]) -> None:
    """Apply net changes (keys, values, `action`) to a table whose catalog supports MERGE."""
    same = [F.col(f"target.{k}").eqNullSafe(F.col(f"source.{k}")) for k in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    action = F.col("source.action")
    values = {c: F.col(f"source.{c}") for c in net.columns if c != "action"}
    (
        net.alias("source")
        .mergeInto(f"{target} AS target", on)
        .whenMatched(action == "delete")
        .delete()
        .whenMatched()
        .update(values)
        .whenNotMatched(action == "upsert")
        .insert(values)
        .merge()
    )


def delete_keys(target: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Target without the rows whose key occurs in `keys`.

    The keys are made distinct before the join, so a key repeated without bound
    reaches the join once and on the partitioning the join needs.
    """
    return target.join(keys.select(*on).distinct(), list(on), "left_anti")


def enough_files(rows: DataFrame, files: int) -> int:
    """`files`, or as many as keep a file, which one task sorts, to about FILE_ROWS rows."""
    return max(files, -(-rows.count() // FILE_ROWS))


def sorted_by_key(rows: DataFrame, keys: Sequence[str], files: int | None = None) -> DataFrame:
    """Write layout: disjoint key ranges, rows in key order inside each file; `files` of them, or more of large tables."""
    args = ([enough_files(rows, files)] if files else []) + list(keys)
    return rows.repartitionByRange(*args).sortWithinPartitions(*keys)


def interleaved(rows: DataFrame, columns: Sequence[str], files: int, bits: int = 6) -> DataFrame:
    """Write layout for filters on any of some columns: rows in the order of their interleaved cell numbers.

    A column is cut at quantiles into 2 ** bits cells, so cells hold about as many rows each
    however skewed it is. Rows that are near in all columns lie in the same row groups, whose
    smallest and largest values then rule them out for a key as well as for a range of times.
    Large tables get more than `files`.
    """
    types = dict(rows.dtypes)
    cells = [chunk_of([F.col(c)], chunk_bounds(rows, [c], 1 << bits), [types[c]]).cast("bigint") for c in columns]
    order = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, cell in enumerate(cells):
            one = F.shiftright(cell, bit).bitwiseAND(F.lit(1))
            order = order.bitwiseOR(F.shiftleft(one, bit * len(cells) + i))
    placed = rows.withColumn("_order", order).repartitionByRange(enough_files(rows, files), "_order", *columns)
    return placed.sortWithinPartitions("_order", *columns).drop("_order")


def split_by_target(rows: DataFrame, path: str, by: Sequence[str] = ("dst_db", "dst_table")) -> None:
    """One write for all targets, a folder each; hot targets spread over several files."""
    rows.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _field(name: str, kind: str, nullable: bool, comment: str | None) -> ST.StructField:
    data_type = ST.StructType.fromDDL(f"x {kind}")[0].dataType
    return ST.StructField(name, data_type, nullable, {"comment": comment} if comment else {})
