"""Shard indexes of source names and the re-sharding functions of a migration."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Columns whose value decides the target shard.
UID_FIELD = "Fuid"
ORDER_FIELD = "Frc_order_id"

# Number of target shards by name.
SHARD_COUNTS = {"ONE": 1, "TEN": 10, "HUNDRED": 100, "THOUSAND": 1000}


def shard_count(name: str | int | None) -> int:
    """Number of shards of a sharding type given by name or number."""
    if name is None:
        return 1
    count = SHARD_COUNTS.get(name, name)
    if count not in SHARD_COUNTS.values():
        raise ValueError(f"unknown sharding type {name!r}")
    return count


def database_index(name: Column | str) -> Column:
    """From the first to the last digit (`a_00_07_db` -> `00_07`); NULL without a digit."""
    return F.nullif(F.regexp_extract(name, "([0-9](?:.*[0-9])?)", 1), F.lit(""))


def table_index(name: Column | str) -> Column:
    """From the first digit to the end (`t2_card_3` -> `2_card_3`); NULL without a digit."""
    return F.nullif(F.regexp_extract(name, "([0-9].*)$", 1), F.lit(""))


def shard_of_uid(uid: Column, count: Column | int) -> Column:
    """Remainder of a non-negative number; NULL for anything else."""
    number = uid.try_cast("bigint")
    return F.when(number >= 0, number % _count(count)).cast("int")


def shard_of_order(order_id: Column, count: Column | int) -> Column:
    """Remainder of the last three digits; NULL if the id does not end in three digits."""
    tail = F.nullif(F.regexp_extract(order_id.cast("string"), "([0-9]{3})$", 1), F.lit(""))
    return (tail.cast("int") % _count(count)).cast("int")


def _count(count: Column | int) -> Column:
    return count if isinstance(count, Column) else F.lit(count)
