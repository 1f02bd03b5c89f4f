"""Small frames for operator tests and a plain-Python replay to compare with."""

from __future__ import annotations

import json

from lakesync.functions.types import ColumnSpec

COLUMNS = [ColumnSpec("id", "BIGINT", is_pk=True), ColumnSpec("v", "VARCHAR")]


def doc(op, row, *, before=None, db="shop_01_db", table="t_event_3", ts_ms=1, file="bin.000001", pos=0, no=0, instance="i0"):
    after = None if op == "d" else row
    before = row if op == "d" else before
    return json.dumps(
        {
            "instance": instance, "op": op, "before": before, "after": after,
            "source": {"db": db, "table": table, "ts_ms": ts_ms, "file": file, "pos": pos, "row": no},
        }
    )


def ddl_doc(text, *, db="shop_01_db", table="t_event_3", ts_ms=1, file="bin.000001", pos=0, instance="i0"):
    return json.dumps(
        {
            "instance": instance,
            "source": {"db": db, "table": table, "ts_ms": ts_ms, "file": file, "pos": pos},
            "historyRecord": json.dumps({"ddl": text}),
        }
    )


def docs(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def rows(df, *columns):
    out = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in out.collect()), key=repr)


def replay(changes, profile, target=()):
    """Apply (op, id, v) in the given order to a dict."""
    table = dict(target)
    for op, key, value in changes:
        if op in ("r", "c"):
            table[key] = value
        elif op == "u":
            if profile == "lake" or key in table:
                table[key] = value
        elif op == "d":
            table.pop(key, None)
    return table
