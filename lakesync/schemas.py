"""Record layouts shared by every operator.

A change travels as one fixed envelope with the row itself held as VARIANT, so
tables of any shape share one stream and decimals stay exact; rows become typed
columns only once the target table is known.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operation codes of a change record.
INSERT = 0
UPDATE_BEFORE = 1
UPDATE_AFTER = 2
DELETE = 3
DDL = 4

OP_CODES = (INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE, DDL)

# Names of the columns added to target tables.
DB_NAME = "db_name"
TABLE_NAME = "table_name"
DB_INDEX = "db_index"
TABLE_INDEX = "table_index"
SYNC_TS = "f_ts"
IS_DEL = "is_del"

# One landed JSON document. `offset` is the optional JSON form of the log position.
ENVELOPE = (
    "instance STRING, op STRING, before VARIANT, after VARIANT, "
    "source STRUCT<db: STRING, `table`: STRING, ts_ms: BIGINT, file: STRING, pos: BIGINT, `row`: INT>, "
    "historyRecord STRING, offset STRING, _malformed STRING"
)

CHANGE_COLUMNS = (
    "instance", "db", "table", "op", "row", "ddl",
    "file", "pos", "row_no", "ts_ms", "incremental",
)

QUARANTINE_COLUMNS = ("reason", *CHANGE_COLUMNS, "document")

ROUTE = (
    "instance STRING, src_db STRING, src_table STRING, dst_db STRING, dst_table STRING, "
    "sharding BOOLEAN, shard_count INT, shard_field STRING, batch_size INT, nodata BOOLEAN"
)

COLUMN_META = (
    "db STRING, `table` STRING, name STRING, type_name STRING, ordinal INT, length INT, comment STRING, "
    "is_pk BOOLEAN, is_uk BOOLEAN, is_autoincrement BOOLEAN"
)

DDL_LOG_COLUMNS = (
    "instance", "src_db", "src_table", "dst_db", "dst_table", "ddl", "file", "pos", "ts_ms",
)

# Bookkeeping columns next to the values of a row; the underscore keeps them clear of
# source column names.
REASON = "_reason"
CHANGE_OP = "_change_op"
CHANGE_ORD = "_change_ord"


def file_number(file: Column | str) -> Column:
    """Numeric suffix of a log file name; as text `bin.999999` would sort after `bin.1000000`."""
    return F.nullif(F.regexp_extract(file, r"([0-9]+)$", 1), F.lit("")).try_cast("bigint")


def order_key() -> Column:
    """Total order of the changes of one key: snapshot rows first, then log position."""
    return F.struct(
        F.col("incremental"),
        F.coalesce(file_number("file"), F.lit(-1)).alias("file_no"),
        F.coalesce("pos", F.lit(-1)).cast("bigint").alias("pos"),
        F.coalesce("row_no", F.lit(0)).cast("int").alias("row_no"),
    )


def lowest_order() -> Column:
    """Order key below every real change, for rows that carry no position."""
    return F.struct(
        F.lit(False).alias("incremental"),
        F.lit(-2).cast("bigint").alias("file_no"),
        F.lit(-1).cast("bigint").alias("pos"),
        F.lit(0).alias("row_no"),
    )


def bookkeeping() -> list[Column]:
    """Operation and position of a change as the columns the fold reads."""
    return [F.col("op").alias(CHANGE_OP), order_key().alias(CHANGE_ORD)]


def evaluated_once(df: DataFrame, columns: Sequence[Column]) -> DataFrame:
    """Select `columns` so that later filters read their results.

    Filters on a plain projection are pushed below it with the whole expression copied
    in; for parsed documents that repeats the costly part per condition. A generated
    row stops the copy (the outer form, since the plain one infers a size filter that
    copies just the same), and no filter on parsed values could reach the scan anyway.
    """
    return df.select(F.array(F.struct(*columns)).alias("_row")).select(F.inline_outer("_row"))
