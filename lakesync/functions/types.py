"""Column metadata and the mapping from MySQL types to Spark types."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

# MySQL type -> Spark type of the target column; others become STRING.
MYSQL_TO_SPARK = {
    "DECIMAL": "decimal(38,20)",
    "DECIMAL UNSIGNED": "decimal(38,20)",
    "TINYINT": "int",
    "TINYINT UNSIGNED": "int",
    "BOOLEAN": "boolean",
    "SMALLINT": "int",
    "SMALLINT UNSIGNED": "int",
    "INT": "int",
    "INT UNSIGNED": "int",
    "MEDIUMINT": "int",
    "MEDIUMINT UNSIGNED": "int",
    "FLOAT": "float",
    "FLOAT UNSIGNED": "float",
    "DOUBLE": "double",
    "DOUBLE UNSIGNED": "double",
    "TIMESTAMP": "timestamp_ntz",
    "DATETIME": "timestamp_ntz",
    "BIGINT": "bigint",
    "BIGINT UNSIGNED": "bigint",
    "DATE": "date",
    "TIME": "time(6)",
    "BIT": "int",
    "BINARY": "binary",
    "BLOB": "binary",
    "TINYBLOB": "binary",
    "MEDIUMBLOB": "binary",
    "LONGBLOB": "binary",
}

# Spark type -> type name written into target ALTER statements.
SPARK_TO_DDL = {
    "decimal(38,20)": "decimal(38, 20)",
    "int": "int",
    "boolean": "boolean",
    "float": "float",
    "double": "double",
    "timestamp_ntz": "timestamp",
    "bigint": "long",
    "date": "date",
    "time(6)": "time",
    "binary": "binary",
    "string": "string",
}

# Wider types that hold every unsigned value.
UNSIGNED_WIDE = {"INT UNSIGNED": "bigint", "BIGINT UNSIGNED": "decimal(20,0)"}

# Logical type names a connector declares for time columns and decimals.
CONNECT_DECIMAL = "org.apache.kafka.connect.data.Decimal"
CONNECT_DATE = "org.apache.kafka.connect.data.Date"
CONNECT_TIME = "org.apache.kafka.connect.data.Time"
CONNECT_TIMESTAMP = "org.apache.kafka.connect.data.Timestamp"
DATE = "io.debezium.time.Date"
TIMESTAMP = "io.debezium.time.Timestamp"
ZONED_TIMESTAMP = "io.debezium.time.ZonedTimestamp"
MICRO_TIME = "io.debezium.time.MicroTime"
NANO_TIME = "io.debezium.time.NanoTime"
MICRO_TIMESTAMP = "io.debezium.time.MicroTimestamp"
NANO_TIMESTAMP = "io.debezium.time.NanoTimestamp"
DECIMAL_BASE64 = CONNECT_DECIMAL + ":base64"

DEFAULT_WIRE = {
    "DATE": DATE,
    "DATETIME": TIMESTAMP,
    "TIMESTAMP": ZONED_TIMESTAMP,
    "TIME": MICRO_TIME,
}


def bare_type(type_name: str) -> str:
    """`int(11) unsigned` -> `INT UNSIGNED`."""
    words = re.sub(r"\([^)]*\)", " ", type_name).upper().split()
    return " ".join(w for i, w in enumerate(words) if i == 0 or w == "UNSIGNED")


def spark_type(type_name: str, widen_unsigned: bool = False) -> str:
    """Spark type of a MySQL type; lookup ignores case and length arguments."""
    name = bare_type(type_name)
    if widen_unsigned and name in UNSIGNED_WIDE:
        return UNSIGNED_WIDE[name]
    return MYSQL_TO_SPARK.get(name, "string")


def ddl_type(type_name: Column) -> Column:
    """Column form of the lookup, giving the name used in target ALTER statements."""
    pairs = [F.lit(x) for name, t in MYSQL_TO_SPARK.items() for x in (name, SPARK_TO_DDL[t])]
    return F.coalesce(F.element_at(F.create_map(*pairs), F.upper(type_name)), F.lit("string"))


@dataclass(frozen=True)
class ColumnSpec:
    """One source column as the catalog describes it."""

    name: str
    type_name: str = "VARCHAR"
    is_pk: bool = False
    is_uk: bool = False
    comment: str | None = None
    length: int | None = None
    wire: str | None = None
    scale: int = 0
    default: object = None
    required: bool = False
    is_autoincrement: bool = False

    @property
    def wire_type(self) -> str | None:
        return self.wire or DEFAULT_WIRE.get(bare_type(self.type_name))

    def spark_type(self, widen_unsigned: bool = False) -> str:
        return spark_type(self.type_name, widen_unsigned)


def specs_from_rows(rows: Iterable) -> list[ColumnSpec]:
    """Column list of one table from its COLUMN_META rows."""
    ordered = sorted(rows, key=lambda r: r["ordinal"])
    return [
        ColumnSpec(
            r["name"], r["type_name"], bool(r["is_pk"]), bool(r["is_uk"]), r["comment"], r["length"],
            is_autoincrement=bool(r["is_autoincrement"]),
        )
        for r in ordered
    ]


def with_wire(specs: Iterable[ColumnSpec], wires: dict[str, str]) -> list[ColumnSpec]:
    """Override the declared wire type of some columns."""
    return [replace(s, wire=wires.get(s.name, s.wire)) for s in specs]
