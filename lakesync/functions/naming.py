"""Names of topics and target namespaces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Environments and the name prefixes of the two layers.
ENVIRONMENTS = ("TEST", "PROD")
ODS_PREFIX = {"PROD": "ods_", "other": "test_ods_"}
DWD_NAME = {"PROD": "dwd", "other": "test_dwd"}


def _environment(env: str) -> str:
    if env not in ENVIRONMENTS:
        raise ValueError(f"env must be one of {ENVIRONMENTS}, not {env!r}")
    return "PROD" if env == "PROD" else "other"


def topic(env: str, db: Column, table: Column, prefix: str = "flink") -> Column:
    """`prefix.db.table` in production, `prefix.env.db.table` elsewhere."""
    parts = [F.lit(prefix)]
    if _environment(env) != "PROD":
        parts.append(F.lit(env.lower()))
    return F.concat_ws(".", *parts, db, table)


def ods_namespace(env: str, db: Column) -> Column:
    return F.concat(F.lit(ODS_PREFIX[_environment(env)]), db)


def ods_namespace_name(env: str, db: str) -> str:
    return ODS_PREFIX[_environment(env)] + db


def dwd_namespace_name(env: str) -> str:
    return DWD_NAME[_environment(env)]
