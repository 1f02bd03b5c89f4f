"""Net changes into a relational target over JDBC.

Spark's writer can only append or overwrite, so the net changes of a batch land in a
staging table, one per batch and therefore repeatable, and three statements of the
target database move them over. The cluster has already reduced the batch to one row
per key, so the order of the statements does not matter for any key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Fixed value: rows per JDBC batch when a route names none.
BATCH_SIZE = 1024


def staging_table(dst_db: str, dst_table: str, batch_id: int) -> str:
    return f"{dst_db}.stage_{dst_table}_{batch_id}"


def write_options(
    url: str, table: str, *, batch_size: int = 0, partitions: int | None = None,
    user: str | None = None, password: str | None = None,
) -> dict[str, str]:
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size if batch_size > 0 else BATCH_SIZE)}
    if partitions:
        options["numPartitions"] = str(partitions)
    if user is not None:
        options |= {"user": user, "password": password or ""}
    return options


def stage(net: DataFrame, options: dict[str, str]) -> None:
    """Write net changes (keys, values, `action`) to their staging table."""
    net.write.format("jdbc").options(**options).mode("overwrite").save()


def statements(target: str, staging: str, columns: Sequence[str], keys: Sequence[str]) -> list[str]:
    """Delete, update-if-present and insert-or-update from staging to target, MySQL spelling.

    A table whose columns are all keys has nothing to update.
    """
    values = [c for c in columns if c not in keys]
    names = ", ".join(_q(c) for c in columns)
    on = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in keys)
    out = [f"DELETE t FROM {target} t JOIN {staging} s ON {on} WHERE s.`action` = 'delete'"]
    if values:
        sets = ", ".join(f"t.{_q(c)} = s.{_q(c)}" for c in values)
        out.append(f"UPDATE {target} t JOIN {staging} s ON {on} SET {sets} WHERE s.`action` = 'update'")
        tail = "ON DUPLICATE KEY UPDATE " + ", ".join(f"{_q(c)} = VALUES({_q(c)})" for c in values)
    else:
        tail = f"ON DUPLICATE KEY UPDATE {_q(keys[0])} = {target}.{_q(keys[0])}"
    out.append(f"INSERT INTO {target} ({names}) SELECT {names} FROM {staging} WHERE `action` = 'upsert' {tail}")
    return out


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
