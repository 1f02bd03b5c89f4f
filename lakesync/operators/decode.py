"""Envelope text to change records."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.session import bounded_broadcast

MALFORMED = "malformed"
NO_IMAGE = "no_image"
BAD_OP = "bad_op"
UNKNOWN_LOG = "unknown_log"
# File numbers of a log that follows another one begin above all of the earlier log's.
GENERATION = 10**9


def op_code(op: Column) -> Column:
    """Wire operation letter to code: absent means DDL, unknown letters count as updates."""
    return (
        F.when(op.isNull(), S.DDL)
        .when(op.isin("r", "c"), S.INSERT)
        .when(op == "d", S.DELETE)
        .otherwise(S.UPDATE_AFTER)
        .cast("tinyint")
    )


def row_image(op: Column, before: Column, after: Column) -> Column:
    """Deletes carry the old row, everything else the new one."""
    image = F.when(op == S.DELETE, before).otherwise(after)
    return F.when(~F.coalesce(F.is_variant_null(image), F.lit(True)), image)


def ddl_text(history_record: Column) -> Column:
    return F.get_json_object(history_record, "$.ddl")


def decode(envelopes: DataFrame, value: str = "value") -> DataFrame:
    """JSON envelopes to CHANGE_COLUMNS plus `before`, `document` and `_reason`.

    One parse per document, no shuffle. `before` stays for key-change splitting;
    `document` is the text of a malformed envelope, which has nothing else to show.
    """
    doc = F.from_json(F.col(value), S.ENVELOPE, {"columnNameOfCorruptRecord": "_malformed"})
    parsed = envelopes.withColumn("_doc", doc)
    op = op_code(F.col("_doc.op"))
    offset = F.from_json("_doc.offset", "file STRING, pos BIGINT")
    ts_ms = F.coalesce("_doc.source.ts_ms", F.lit(0).cast("bigint"))
    image = row_image(op, F.col("_doc.before"), F.col("_doc.after"))
    columns = [
        F.col("_doc.instance").alias("instance"),
        F.col("_doc.source.db").alias("db"),
        F.col("_doc.source.table").alias("table"),
        op.alias("op"),
        F.when(op != S.DDL, image).alias("row"),
        F.when(op == S.DDL, ddl_text(F.col("_doc.historyRecord"))).alias("ddl"),
        F.coalesce("_doc.source.file", offset["file"]).alias("file"),
        F.coalesce("_doc.source.pos", offset["pos"]).alias("pos"),
        F.coalesce("_doc.source.row", F.lit(0)).alias("row_no"),
        ts_ms.alias("ts_ms"),
        ((ts_ms > 0) & (op != S.DDL)).alias("incremental"),
        row_image(F.lit(S.DELETE), F.col("_doc.before"), F.col("_doc.before")).alias("before"),
        F.col("_doc._malformed").alias("document"),
        F.when(F.col("_doc._malformed").isNotNull() | F.col("_doc").isNull(), F.lit(MALFORMED))
        .when((op != S.DDL) & image.isNull(), F.lit(NO_IMAGE))
        .alias("_reason"),
    ]
    return S.evaluated_once(parsed, columns)


def log_base(file: Column) -> Column:
    """Name of a log without the number of its file."""
    return F.regexp_replace(file, "[0-9]+$", "")


def continued(changes: DataFrame, logs: DataFrame) -> DataFrame:
    """Let the file numbers of an instance rise over a change of its log.

    After a failover or a log reset, files are numbered from 1 again under another name, and
    later changes would lose to older ones. `logs` (instance, base, generation) lists the
    names in their order, from 0; the files of generation g count from g * GENERATION. A
    change of a log that is not listed is set aside, since nothing tells its place.
    """
    known = bounded_broadcast(logs.select("instance", F.col("base").alias("_base"), F.col("generation").alias("_generation")))
    marked = changes.withColumn("_base", log_base(F.col("file")))
    joined = marked.join(known, ["instance", "_base"], "left")
    number = S.file_number("file") + F.col("_generation") * GENERATION
    named = F.when(F.col("_generation") > 0, F.concat("_base", number.cast("string"))).otherwise(F.col("file"))
    lost = (F.trim("file") != "") & F.col("_generation").isNull()
    out = joined.withColumns({"file": named, S.REASON: F.coalesce(S.REASON, F.when(lost, F.lit(UNKNOWN_LOG)))})
    return out.select(*changes.columns)


def bad_op(changes: DataFrame, op: str = "op") -> DataFrame:
    """Mark records whose stored operation code is none of the known ones."""
    known = F.coalesce(F.col(op).isin(*S.OP_CODES), F.lit(False))
    return changes.withColumn("_reason", F.when(~known, F.lit(BAD_OP)).otherwise(F.col("_reason")))


def split_key_updates(changes: DataFrame, key_of: Callable[[Column], Column]) -> DataFrame:
    """Turn an update that changes the key into a delete of the old and an insert of the new row.

    `key_of` maps a VARIANT row to its key, an array. Both parts keep the position of
    the update: they hit different keys, so they need no order between them. An old
    row without a whole key tells nothing about the key.
    """
    old_key = key_of(F.col("before"))
    moved = (
        (F.col("op") == S.UPDATE_AFTER)
        & F.col("before").isNotNull()
        & F.coalesce(F.forall(old_key, lambda k: k.isNotNull()), F.lit(False))
        & ~old_key.eqNullSafe(key_of(F.col("row")))
    )

    def part(op: Column, row: Column) -> Column:
        return F.struct(op.cast("tinyint").alias("op"), row.alias("row"))

    parts = F.when(
        moved, F.array(part(F.lit(S.DELETE), F.col("before")), part(F.lit(S.INSERT), F.col("row")))
    ).otherwise(F.array(part(F.col("op"), F.col("row"))))
    rest = [c for c in changes.columns if c not in ("op", "row")]
    return (
        changes.select(*rest, parts.alias("_parts"))
        .select(*rest, F.explode_outer("_parts").alias("_part"))
        .select("*", F.col("_part.op").alias("op"), F.col("_part.row").alias("row"))
        .drop("_part")
    )
