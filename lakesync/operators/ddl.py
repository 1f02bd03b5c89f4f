"""DDL events: capture, ALTER actions, target statements, schema evolution.

All of it is expressions over the DDL text of a row; there is no SQL parser. ADD, CHANGE,
MODIFY, RENAME and DROP of columns are recognised (MODIFY and RENAME as a CHANGE that keeps
the name or the type), anything else becomes a SKIP action.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from lakesync import files, schemas as S
from lakesync.functions import wire
from lakesync.functions.types import ColumnSpec, ddl_type, spark_type
from lakesync.operators.quality import BLANK_OFFSET
from lakesync.operators.typed import BAD_CAST, unfit

ADD = "ADD"
CHANGE = "CHANGE"
DROP = "DROP"
SKIP = "SKIP"

_QUOTED = r"""'(?:[^'\\]|''|\\.)*+'|"(?:[^"\\]|""|\\.)*+"|`[^`]*+`"""
_GROUP = rf"\((?:[^()'\"`]|{_QUOTED}|\((?:[^()'\"`]|{_QUOTED})*+\))*+\)"
# Pieces between top-level semicolons, and between top-level commas.
_STATEMENT = rf"(?:[^;'\"`]|{_QUOTED})++"
_ITEM = rf"(?:[^,()'\"`]|{_QUOTED}|{_GROUP})++"
_NAME = r"(`[^`]+`|[\w$]+)"
_NOT_A_COLUMN = (
    r"(?!(?:index|key|primary|unique|fulltext|spatial|constraint|foreign|partition|check)\b)"
)
_ALTER = rf"(?is)^\s*alter\s+(?:ignore\s+)?table\s+{_NAME}(?:\s*\.\s*{_NAME})?\s+(.*?)\s*$"
_COLUMN = rf"(?is)^\s*{_NAME}\s+(\w+)(?:\s*\([^)]*\))?(\s+unsigned)?.*$"


def capture(routed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """DDL rows of a routed batch as (log rows, rows to quarantine).

    Rows without a log position are set aside. Several events at the same position of
    one instance are one event; the earliest wins.
    """
    events = routed.where((F.col("op") == S.DDL) & F.col("_reason").isNull())
    blank = F.trim(F.coalesce("file", F.lit(""))) == ""
    log = dedupe(
        events.where(~blank).select(
            "instance",
            F.col("db").alias("src_db"),
            F.col("table").alias("src_table"),
            "dst_db",
            "dst_table",
            "ddl",
            "file",
            "pos",
            "ts_ms",
        )
    )
    return log, events.where(blank).withColumn("_reason", F.lit(BLANK_OFFSET))


LOG_SCHEMA = (
    "instance string, src_db string, src_table string, dst_db string, dst_table string, ddl string, file string, pos bigint, ts_ms bigint"
)


def dedupe(log: DataFrame) -> DataFrame:
    """First event per instance and log position."""
    keys = ["instance", "file", "pos"]
    rest = [c for c in log.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct("ts_ms", "src_db", "src_table", "ddl"))
    return log.groupBy(*keys).agg(first.alias("_first")).select(
        *[F.col(c) if c in keys else F.col(f"_first.{c}") for c in log.columns]
    )


def read_log(spark: SparkSession, root: str) -> DataFrame:
    """DDL log of a job over all its batches; an event repeated in a later batch counts once."""
    if not files.children(spark, f"{root}/ddl_log"):
        return spark.createDataFrame([], LOG_SCHEMA)
    return dedupe(spark.read.parquet(f"{root}/ddl_log").select(*S.DDL_LOG_COLUMNS))


def merge_log(spark: SparkSession, root: str) -> None:
    """Put the log's folders into a new one, as one file.

    The folders that went into it are deleted only after it is complete, and an event that is in two counts once.
    """
    folders = files.children(spark, f"{root}/ddl_log")
    if len(folders) < 2:
        return
    lowest = min(0, *(int(f.rsplit("=", 1)[1]) for f in folders))
    read_log(spark, root).coalesce(1).write.parquet(f"{root}/ddl_log/batch_id={lowest - 1}")
    for folder in folders:
        files.delete(spark, f"{root}/ddl_log/{folder}")


def dedupe_stream(log: DataFrame, event_time: str, delay: str) -> DataFrame:
    """Streaming form; state older than the delay is dropped."""
    return log.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["instance", "file", "pos"])


def in_log_order(log: DataFrame) -> DataFrame:
    return log.orderBy("ts_ms", S.file_number("file"), "pos")


def unquoted(name: Column) -> Column:
    """Name without surrounding backticks."""
    return F.btrim(name, F.lit("`"))


def action_list(ddl: Column) -> Column:
    """Array of actions of one DDL text, in order; no rows move and nothing is grouped."""
    statements = F.regexp_extract_all(ddl, F.lit(_STATEMENT), F.lit(0))
    statements = F.filter(statements, lambda s: F.trim(s) != "")
    return F.flatten(F.transform(statements, _statement_actions))


def actions(log: DataFrame) -> DataFrame:
    """One row per ALTER action: `seq` and the fields of the action."""
    exploded = log.select(*log.columns, F.posexplode(action_list(F.col("ddl"))).alias("seq", "_a"))
    return exploded.select(*log.columns, "seq", "_a.*")


def target_ddl(ddl: Column, dst_db: Column, dst_table: Column) -> Column:
    """Target ALTER statements, duplicates removed in order, separated by `;` and newline."""
    head = F.concat(F.lit("alter table "), dst_db, F.lit("."), dst_table, F.lit(" "))
    texts = F.flatten(F.transform(action_list(ddl), lambda a: _action_texts(a, head)))
    return F.array_join(F.array_distinct(texts), ";\n")


def ddl_report(log: DataFrame, template: str | None = None) -> DataFrame:
    """Audit of DDL events with the statements for the target.

    A template with eight %s takes: number, application, job, target database, target
    table, offset, source DDL, target DDL; here `application` and `job` come as columns
    or are empty.
    """
    number = F.concat_ws("_", "instance", "file", "pos")
    offset = F.to_json(F.struct("file", "pos"))
    text = target_ddl(F.col("ddl"), F.col("dst_db"), F.col("dst_table"))
    report = log.withColumns({"order_no": number, "source_offset": offset, "target_ddl": text})
    if template is None:
        return report
    extra = [F.col(c) if c in log.columns else F.lit("") for c in ("application", "job")]
    return report.withColumn(
        "message",
        F.format_string(template, "order_no", *extra, "dst_db", "dst_table", "source_offset", "ddl", "target_ddl"),
    )


# --- schema evolution -------------------------------------------------------


@dataclass
class Evolution:
    """Schema of one target after some DDL events.

    `history` holds, per current column, its source names with the log position from
    which each applies, so rows from before and after a DDL can share one projection.
    """

    columns: list[ColumnSpec]
    history: dict[str, list[tuple[tuple[int, int], str]]] = field(default_factory=dict)
    changed: bool = False
    # Positions (file number, position) of the events with an action that changed the schema.
    used: set[tuple[int, int]] = field(default_factory=set)

    @staticmethod
    def start(columns: Sequence[ColumnSpec]) -> "Evolution":
        return Evolution(list(columns), {c.name: [((-2, -1), c.name)] for c in columns})

    def names(self) -> list[str]:
        return [c.name for c in self.columns]


def evolve(columns: Sequence[ColumnSpec], action_rows: Iterable[Row]) -> Evolution:
    """Fold actions, in log order, into the column list of one target.

    Add only if absent; change retypes, comments, renames and moves; drop removes.
    The state is one column list, however long the log is.
    """
    state = Evolution.start(columns)
    for a in action_rows:
        at = (_file_no(a["file"]), a["pos"] if a["pos"] is not None else -1)
        if a["action"] == ADD and a["column_name"] not in state.names():
            spec = ColumnSpec(a["column_name"], a["type_name"], comment=a["comment"])
            state.columns.append(spec)
            state.history[spec.name] = [(at, spec.name)]
            _move(state, spec.name, a)
        elif a["action"] == CHANGE and a["column_name"] in state.names():
            _change(state, a, at)
        elif a["action"] == DROP and a["column_name"] in state.names():
            state.columns = [c for c in state.columns if c.name != a["column_name"]]
            state.history.pop(a["column_name"])
        else:
            continue
        state.changed = True
        state.used.add(at)
    return state


def evolve_from_log(columns: Sequence[ColumnSpec], log: DataFrame, dst_db: str, dst_table: str) -> Evolution:
    """Evolution of one target; actions stream to the driver one partition at a time."""
    own = log.where((F.col("dst_db") == dst_db) & (F.col("dst_table") == dst_table))
    ordered = actions(own).orderBy("ts_ms", S.file_number("file"), "pos", "seq")
    return evolve(columns, ordered.toLocalIterator())


def evolved_rows(
    changes: DataFrame, evolution: Evolution, *, carry: Sequence[str | Column] = (), position: Column | None = None
) -> DataFrame:
    """Typed rows of the evolved target from VARIANT rows of any schema version.

    Each row reads a column under the name it had at the log `position` (file number,
    position) of the row, by default taken from the change columns. A value that does
    not fit sets `_reason`.
    """
    if position is None:
        position = F.struct(
            F.coalesce(S.file_number("file"), F.lit(-1)).alias("file_no"),
            F.coalesce("pos", F.lit(-1)).cast("bigint").alias("pos"),
        )
    out = [c if isinstance(c, Column) else F.col(c) for c in carry]
    bad = F.lit(False)
    for spec in evolution.columns:
        value, wrong = F.when(F.lit(False), F.lit(None)), F.when(F.lit(False), False)
        for (file_no, pos), name in reversed(evolution.history[spec.name]):
            here = position >= F.struct(
                F.lit(file_no).cast("bigint").alias("file_no"), F.lit(pos).cast("bigint").alias("pos")
            )
            named = ColumnSpec(name, spec.type_name, wire=spec.wire, scale=spec.scale)
            read = wire.typed_field(F.col("row"), named)
            value = value.when(here, read)
            wrong = wrong.when(here, unfit(F.col("row"), named, read))
        bad = bad | F.coalesce(wrong, F.lit(False))
        out.append(value.alias(spec.name))
    return S.evaluated_once(changes, [*out, F.when(bad, F.lit(BAD_CAST)).alias(S.REASON)])


def evolved_table(table: DataFrame, evolution: Evolution) -> DataFrame:
    """Existing target data in the evolved layout: renamed, moved, cast, added, dropped."""
    out = []
    for spec in evolution.columns:
        kind = spec.spark_type()
        first = evolution.history[spec.name][0][1]
        if first in table.columns and evolution.history[spec.name][0][0] == (-2, -1):
            out.append(F.col(first).try_cast(kind).alias(spec.name, metadata=_comment(spec)))
        else:
            out.append(F.lit(None).cast(kind).alias(spec.name, metadata=_comment(spec)))
    return table.select(*out)


def evolution_status(log: DataFrame, evolution: Evolution) -> DataFrame:
    """Sync result per DDL event of the evolved target: whether one of its actions changed the schema."""
    used = F.array(*[F.struct(F.lit(f).cast("bigint").alias("n"), F.lit(p).cast("bigint").alias("p")) for f, p in sorted(evolution.used)])
    at = F.struct(F.coalesce(S.file_number("file"), F.lit(-1)).alias("n"), F.coalesce("pos", F.lit(-1)).cast("bigint").alias("p"))
    applied = F.array_contains(used, at) if evolution.used else F.lit(False)
    return log.withColumn("status", F.when(applied, "applied").otherwise("unchanged"))


def specs_of(schema: ST.StructType) -> list[ColumnSpec]:
    """Column list of an existing table, types in MySQL terms."""
    names = {
        "int": "INT", "bigint": "BIGINT", "double": "DOUBLE", "float": "FLOAT", "boolean": "BOOLEAN",
        "timestamp_ntz": "DATETIME", "date": "DATE", "binary": "BLOB", "time(6)": "TIME",
    }
    return [
        ColumnSpec(
            f.name,
            "DECIMAL" if isinstance(f.dataType, ST.DecimalType) else names.get(f.dataType.simpleString(), "VARCHAR"),
            comment=(f.metadata or {}).get("comment"),
        )
        for f in schema.fields
    ]


# --- helpers ----------------------------------------------------------------


def _action(kind, column, new_name, type_name, comment, first, after) -> Column:
    return F.struct(
        F.lit(kind).alias("action"),
        column.alias("column_name"),
        new_name.alias("new_name"),
        type_name.alias("type_name"),
        comment.alias("comment"),
        first.alias("first"),
        after.alias("after_col"),
    )


def _group(text: Column, pattern: str, i: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, i), F.lit(""))


def _none() -> Column:
    return F.lit(None).cast("string")


def _skip(text: Column) -> Column:
    none = _none()
    return _action(SKIP, none, none, none, F.trim(text), F.lit(False), none)


def _statement_actions(statement: Column) -> Column:
    body = F.regexp_extract(statement, _ALTER, 3)
    items = F.regexp_extract_all(body, F.lit(_ITEM), F.lit(0))
    found = F.flatten(F.transform(items, _item_actions))
    return F.when(F.rlike(statement, F.lit(_ALTER)), found).otherwise(F.array(_skip(statement)))


def _item_actions(item: Column) -> Column:
    add = rf"(?is)^\s*add\s+(?:column\s+)?{_NOT_A_COLUMN}(?:if\s+not\s+exists\s+)?"
    many = rf"(?is)^\s*add\s+(?:column\s+)?\((.*)\)\s*$"
    change = rf"(?is)^\s*change\s+(?:column\s+)?{_NAME}\s+(.*)$"
    modify = r"(?is)^\s*modify\s+(?:column\s+)?"
    rename = rf"(?is)^\s*rename\s+column\s+{_NAME}\s+to\s+{_NAME}\s*$"
    drop = rf"(?is)^\s*drop\s+(?:column\s+)?{_NOT_A_COLUMN}(?:if\s+exists\s+)?{_NAME}\s*$"
    bare = rf"(?is)^\s*{_NAME}\s*$"
    none = _none()

    def dropped(pattern: str) -> Column:
        name = unquoted(F.regexp_extract(item, pattern, 1))
        return F.array(_action(DROP, name, none, none, none, F.lit(False), none))

    listed = F.filter(
        F.regexp_extract_all(F.regexp_extract(item, many, 1), F.lit(_ITEM), F.lit(0)),
        lambda d: F.rlike(d, F.lit(_COLUMN)),
    )
    single = F.regexp_replace(item, add, "")
    definition = F.regexp_extract(item, change, 2)
    old_name = unquoted(F.regexp_extract(item, change, 1))
    modified = F.regexp_replace(item, modify, "")
    kept_name = unquoted(F.regexp_extract(modified, _COLUMN, 1))
    from_name, to_name = (unquoted(F.regexp_extract(item, rename, i)) for i in (1, 2))
    return (
        F.when(F.rlike(item, F.lit(many)), F.transform(listed, lambda d: _definition(ADD, d, None)))
        .when(
            F.rlike(item, F.lit(add)) & F.rlike(single, F.lit(_COLUMN)),
            F.array(_definition(ADD, single, None)),
        )
        .when(
            F.rlike(item, F.lit(change)) & F.rlike(definition, F.lit(_COLUMN)),
            F.array(_definition(CHANGE, definition, old_name)),
        )
        .when(
            F.rlike(item, F.lit(modify)) & F.rlike(modified, F.lit(_COLUMN)),
            F.array(_definition(CHANGE, modified, kept_name)),
        )
        .when(
            F.rlike(item, F.lit(rename)),
            F.array(_action(CHANGE, from_name, to_name, none, none, F.lit(False), none)),
        )
        .when(F.rlike(item, F.lit(drop)), dropped(drop))
        .when(F.rlike(item, F.lit(bare)), dropped(bare))
        .otherwise(F.array(_skip(item)))
    )


def _definition(kind: str, text: Column, old_name: Column | None) -> Column:
    name = unquoted(F.regexp_extract(text, _COLUMN, 1))
    type_name = F.upper(
        F.concat(F.regexp_extract(text, _COLUMN, 2), F.regexp_replace(F.regexp_extract(text, _COLUMN, 3), r"\s+", " "))
    )
    raw = _group(text, r"(?is)\bcomment\s+('(?:[^'\\]|''|\\.)*+'|\"(?:[^\"\\]|\"\"|\\.)*+\")", 1)
    inner = F.substring(raw, F.lit(2), F.length(raw) - 2)
    comment = F.regexp_replace(F.regexp_replace(inner, "''", "'"), r"\\(.)", "$1")
    tail = F.regexp_replace(text, r"""'(?:[^'\\]|''|\\.)*+'|"(?:[^"\\]|""|\\.)*+\"""", "")
    after = unquoted(_group(tail, rf"(?is)\bafter\s+{_NAME}\s*$", 1))
    first = F.rlike(tail, F.lit(r"(?is)\sfirst\s*$"))
    column = name if old_name is None else old_name
    new_name = _none() if old_name is None else name
    return _action(kind, column, new_name, type_name, comment, first, after)


def _action_texts(a: Column, head: Column) -> Column:
    quoted = F.concat(F.lit("'"), F.regexp_replace(F.coalesce(a["comment"], F.lit("")), "'", r"\\'"), F.lit("'"))
    place = (
        F.when(a["first"], F.lit(" first"))
        .when(a["after_col"].isNotNull(), F.concat(F.lit(" after "), a["after_col"]))
        .otherwise(F.lit(""))
    )
    add = F.concat(
        head, F.lit("add columns ("), a["column_name"], F.lit(" "), ddl_type(a["type_name"]),
        F.lit(" comment "), quoted, place, F.lit(")"),
    )
    renamed = F.when(
        a["column_name"] != a["new_name"],
        F.concat(head, F.lit("rename column "), a["column_name"], F.lit(" to "), a["new_name"]),
    )
    alter = F.concat(head, F.lit("alter column "), a["new_name"])
    moved = F.when(place != "", F.concat(alter, place))
    noted = F.when(a["comment"].isNotNull(), F.concat(alter, F.lit(" comment "), quoted))
    drop = F.concat(head, F.lit("drop column "), a["column_name"])
    texts = (
        F.when(a["action"] == ADD, F.array(add))
        .when(a["action"] == CHANGE, F.array(renamed, moved, noted))
        .when(a["action"] == DROP, F.array(drop))
        .otherwise(F.array().cast("array<string>"))
    )
    return F.filter(texts, lambda t: t.isNotNull())


def _file_no(name: str | None) -> int:
    found = re.search(r"[0-9]+$", name or "")
    return int(found[0]) if found else -1


def _change(state: Evolution, a: Row, at: tuple[int, int]) -> None:
    old, new = a["column_name"], a["new_name"]
    i = state.names().index(old)
    was = state.columns[i]
    comment = a["comment"] if a["comment"] is not None else was.comment
    type_name = a["type_name"] or was.type_name
    same = spark_type(type_name) == was.spark_type()
    state.columns[i] = ColumnSpec(
        new, type_name, was.is_pk, was.is_uk, comment, was.length, was.wire if same else None, was.scale
    )
    steps = state.history.pop(old)
    state.history[new] = steps if old == new else [*steps, (at, new)]
    _move(state, new, a)


def _move(state: Evolution, name: str, a: Row) -> None:
    """The place may name a column renamed earlier; names in the list are current ones."""
    if not a["first"] and a["after_col"] is None:
        return
    spec = next(c for c in state.columns if c.name == name)
    rest = [c for c in state.columns if c.name != name]
    if a["first"]:
        at = 0
    else:
        names = [c.name for c in rest]
        at = names.index(a["after_col"]) + 1 if a["after_col"] in names else len(rest)
    state.columns = [*rest[:at], spec, *rest[at:]]


def _comment(spec: ColumnSpec) -> dict:
    return {"comment": spec.comment} if spec.comment else {}
