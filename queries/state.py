"""Current state: both profiles, batches, replays, history, downstream."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.operators import decode, fold, history, quality
from lakesync.operators.typed import typed_rows
from lakesync.plans import layers, sync
from lakesync.session import run_dir
from lakesync.sinks import jdbc, tables
from lakesync.sinks.store import StateStore
from lakesync.sources import envelopes, snapshot
from queries import feed as E

RESULT = f"id, user_id, value, event_type, {E.TS_SQL}"


def typed_feed(spark, sf_dir, **options):
    routes = E.shop_routes(spark, sf_dir)
    return sync.typed_changes(E.feed(spark, sf_dir), E.EVENT_COLUMNS, routes=routes, **options)


def lake_current(spark, sf_dir):
    """Flagship: envelopes, route, typed rows with lineage, fold, current rows."""
    routes = E.shop_routes(spark, sf_dir)
    rows = sync.current_rows(
        E.feed(spark, sf_dir), E.EVENT_COLUMNS, fold.LAKE, routes=routes, lineage=True, f_ts=1_700_000_000_000
    )
    return E.event_result(rows, S.DB_NAME, S.TABLE_NAME, S.SYNC_TS)


def _log_and_target(spark, sf_dir):
    """Target holding the snapshot rows, and the typed log behind it."""
    good = quality.accepted(typed_feed(spark, sf_dir))
    snap = good.where(~F.col(S.CHANGE_ORD)["incremental"])
    target = fold.current(fold.fold(snap, ["id"]), ["id"], fold.LAKE)
    return target, good.where(F.col(S.CHANGE_ORD)["incremental"])


def migration_current(spark, sf_dir):
    """Log applied to a target that was filled by the snapshot; updates need their row."""
    target, log = _log_and_target(spark, sf_dir)
    return E.event_result(fold.apply(target, fold.fold(log, ["id"]), ["id"], fold.MIGRATION))


def lake_apply(spark, sf_dir):
    """The same log on the same target with upsert semantics."""
    target, log = _log_and_target(spark, sf_dir)
    return E.event_result(fold.apply(target, fold.fold(log, ["id"]), ["id"], fold.LAKE))


def migration_merged(spark, sf_dir):
    """Migration state by one aggregation over target rows and changes."""
    target, log = _log_and_target(spark, sf_dir)
    states = fold.seed(target, ["id"]).unionByName(fold.fold(log, ["id"]))
    return E.event_result(fold.current(fold.merge(states, ["id"]), ["id"], fold.MIGRATION))


def snapshot_then_log(spark, sf_dir):
    """Snapshot of a table read directly plus the log behind its position."""
    events = E.table(spark, sf_dir, "events")
    parts = E.event_parts(events)
    snap_rows = parts.where("op = 'r'").select("image.*")
    high = ("bin.000002", 2500)
    snap = snapshot.snapshot(snap_rows, "i0", "shop_00_db", "t_event_0", file="bin.000000", pos=-1)
    # Several snapshot rows share a key here; number them as a real snapshot never needs to.
    snap = snap.withColumn("pos", F.try_variant_get("row", "$.ts", "bigint"))
    log = decode.decode(E.event_envelopes(events))
    both = envelopes.snapshot_then_log(snap, log, high)
    rows = quality.accepted(typed_rows(both.where(F.col("op") != S.DDL), E.EVENT_COLUMNS, carry=S.bookkeeping()))
    return E.event_result(fold.current(fold.fold(rows, ["id"]), ["id"], fold.LAKE))


def net_change_counts(spark, sf_dir):
    """Net changes of the log by action and profile, as a relational target would get them."""
    _, log = _log_and_target(spark, sf_dir)
    states = fold.fold(log, ["id"])
    verdicts = F.array(
        *[F.struct(F.lit(p).alias("profile"), fold.action(p).alias("action")) for p in (fold.LAKE, fold.MIGRATION)]
    )
    return states.select(F.inline(verdicts)).groupBy("profile", "action").agg(F.count(F.lit(1)).alias("keys"))


def stored_apply(spark, sf_dir):
    """Net changes stored first, then applied to the target where it lies."""
    target, log = _log_and_target(spark, sf_dir)
    path = run_dir(spark, "net")
    fold.fold(log, ["id"]).write.parquet(path)
    return E.event_result(fold.apply_stored(target, spark.read.parquet(path), ["id"], fold.MIGRATION))


def out_of_order_batches(spark, sf_dir):
    """The feed scattered over seven batches, one of them replayed, then merged."""
    good = quality.accepted(typed_feed(spark, sf_dir))
    batch = F.col(S.CHANGE_ORD)["pos"] * 37 % 7
    states = fold.fold(good.withColumn("batch", batch), ["id", "batch"], F.struct("user_id", "value", "event_type", "ts"))
    replayed = states.where("batch = 3")
    merged = fold.merge(states.unionByName(replayed), ["id"])
    return E.event_result(fold.current(merged, ["id"], fold.MIGRATION))


def key_violations(spark, sf_dir):
    """Keys that occur several times in a table that claims them unique."""
    rows = E.table(spark, sf_dir, "lineitem")
    return fold.key_violations(rows, ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", F.col("l_linenumber").cast("bigint").alias("l_linenumber"), "rows"
    )


def key_delete(spark, sf_dir):
    """Orders without those that have a returned line."""
    orders = E.table(spark, sf_dir, "orders")
    returned = E.table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    keys = returned.select(F.col("l_orderkey").alias("o_orderkey"))
    return tables.delete_keys(orders, keys, ["o_orderkey"]).select("o_orderkey", "o_custkey", "o_totalprice")


def key_change_split(spark, sf_dir):
    """Updates that move a row to another key: the old key must go."""
    e = E.event_parts(E.table(spark, sf_dir, "events"))
    moved = (F.col("op") == "u") & (F.col("event_id") % 5 == 0)
    # The old row had an odd id, the new one the even id next to it.
    image = F.col("image")
    base = image.withField("id", image["id"] * 2)
    old = F.when(moved, base.withField("id", base["id"] + 1)).otherwise(base)
    docs = e.select(
        E.envelope(
            F.when(F.col("op") == "u", F.lit("u")).otherwise(F.lit("c")),
            F.when(F.col("op") == "u", old),
            F.when(F.col("op") == "u", base).otherwise(
                F.when(F.col("event_id") % 2 == 0, base).otherwise(base.withField("id", base["id"] + 1))
            ),
            F.col("db"), F.col("tbl"), F.lit(1).cast("bigint"), F.col("file"), F.col("event_id"),
        ).alias("value")
    )
    rows = sync.current_rows(docs, E.EVENT_COLUMNS, fold.MIGRATION)
    return rows.select("id", "user_id", "value")


def change_history(spark, sf_dir):
    """Every log change with version number and validity; no window spans a whole key."""
    rows = decode.decode(E.feed(spark, sf_dir)).where("incremental")
    keyed = rows.withColumn("id", F.try_variant_get("row", "$.id", "bigint"))
    out = history.change_history(keyed, ["id"])
    return out.select("id", "pos", F.col("op").cast("int").alias("op"), "version", "valid_from", "valid_to")


def dwd_increment(spark, sf_dir):
    """Downstream orders after an increment with soft deletes."""
    orders = E.table(spark, sf_dir, "orders")
    ods = orders.select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.col("o_orderkey").alias(S.SYNC_TS),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias(S.IS_DEL),
    )
    old = ods.where("o_orderkey % 2 = 0").select(
        "o_orderkey", "o_custkey", F.lit(0.0).alias("o_totalprice"), F.lit(0).cast("bigint").alias(S.SYNC_TS)
    )
    return layers.clean_apply(old, ods, ["o_orderkey"], since=500)


def compacted_current(spark, sf_dir):
    """Seven stored batches, compactions of both kinds, expiry, a replay, then the state."""
    store, routes = StateStore(spark, run_dir(spark, "compacted")), E.keyed_routes(spark, sf_dir)
    routed = sync.targets(sync.routed_changes(E.feed(spark, sf_dir), routes), fold.LAKE)
    for n in range(7):
        store.write_batch(n, sync.states(routed.where(F.col("pos") * 37 % 7 == n), 1_700_000_000_000))
        if n in (1, 3, 5):
            store.compact(full=n == 3)
            store.expire()
    store.write_batch(6, sync.states(routed.where(F.col("pos") * 37 % 7 == 6), 1_700_000_000_000))
    rows = store.current("shop_db", "t_event", E.EVENT_COLUMNS, fold.LAKE, lineage=True, sync_time=True)
    return E.event_result(rows, S.DB_NAME, S.TABLE_NAME, S.SYNC_TS)


def staged_net_changes(spark, sf_dir):
    """Rows a staging table of a relational target receives, one per key."""
    _, log = _log_and_target(spark, sf_dir)
    net = fold.net_changes(fold.fold(log, ["id"]), ["id"], fold.MIGRATION)
    assert jdbc.statements("t", "s", net.drop("action").columns, ["id"])
    return net.select("id", "action", F.coalesce("value", F.lit(-1.0)).alias("value"))


QUERIES = {
    "lake_current": lake_current,
    "migration_current": migration_current,
    "lake_apply": lake_apply,
    "migration_merged": migration_merged,
    "snapshot_then_log": snapshot_then_log,
    "net_change_counts": net_change_counts,
    "stored_apply": stored_apply,
    "out_of_order_batches": out_of_order_batches,
    "key_violations": key_violations,
    "key_delete": key_delete,
    "key_change_split": key_change_split,
    "change_history": change_history,
    "dwd_increment": dwd_increment,
    "compacted_current": compacted_current,
    "staged_net_changes": staged_net_changes,
}

LAKE_WITH_LINEAGE = (
    f"WITH {E.lake_sql()} SELECT db AS db_name, tbl AS table_name, "
    f"CAST(1700000000000 AS BIGINT) AS f_ts, {RESULT} FROM cur"
)

ORACLE = {
    "lake_current": LAKE_WITH_LINEAGE,
    "migration_current": f"WITH {E.migration_sql()} SELECT {RESULT} FROM cur",
    "lake_apply": f"WITH {E.lake_sql()} SELECT {RESULT} FROM cur",
    "stored_apply": f"WITH {E.migration_sql()} SELECT {RESULT} FROM cur",
    "migration_merged": f"WITH {E.migration_sql()} SELECT {RESULT} FROM cur",
    "snapshot_then_log": f"WITH {E.lake_sql('snap OR event_id > 2500')} SELECT {RESULT} FROM cur",
    "net_change_counts": f"""WITH {E.E_SQL},
f AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id DESC) AS rn FROM e WHERE NOT snap),
lake AS (SELECT CASE WHEN op = 3 THEN 'delete' ELSE 'upsert' END AS action FROM f WHERE rn = 1),
mig AS (SELECT CASE arg_max(op, event_id) FILTER (WHERE op IN (0, 3))
               WHEN 3 THEN 'delete' WHEN 0 THEN 'upsert' ELSE 'update' END AS action
        FROM e WHERE NOT snap GROUP BY id)
SELECT 'lake' AS profile, action, count(*) AS keys FROM lake GROUP BY action
UNION ALL SELECT 'migration', action, count(*) FROM mig GROUP BY action""",
    "out_of_order_batches": f"WITH {E.migration_sql()} SELECT {RESULT} FROM cur",
    "key_violations": """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS rows
FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
    "key_delete": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders o WHERE NOT EXISTS
(SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R')""",
    "key_change_split": f"""WITH {E.E_SQL},
u AS (SELECT *, NOT snap AND event_type NOT IN ('signup', 'error') AS upd FROM e),
c AS (SELECT event_id, user_id, value, 0 AS part, CASE WHEN upd AND event_id % 5 <> 0 THEN 2 ELSE 0 END AS op,
             CASE WHEN upd OR event_id % 2 = 0 THEN id * 2 ELSE id * 2 + 1 END AS id FROM u
      UNION ALL SELECT event_id, user_id, value, 0, 3, id * 2 + 1 FROM u WHERE upd AND event_id % 5 = 0),
a AS (SELECT id, max(event_id) AS an, arg_max(op, event_id) AS aop FROM c WHERE op IN (0, 3) GROUP BY id),
i AS (SELECT id, arg_max(user_id, event_id) AS user_id, arg_max(value, event_id) AS value
      FROM c WHERE op IN (0, 2) GROUP BY id)
SELECT i.* FROM i JOIN a ON a.id = i.id WHERE aop = 0""",
    "change_history": f"""WITH {E.E_SQL}
SELECT id, event_id AS pos, op,
  row_number() OVER (PARTITION BY id ORDER BY event_id) AS version,
  ts_ms AS valid_from, lead(ts_ms) OVER (PARTITION BY id ORDER BY event_id) AS valid_to
FROM e WHERE NOT snap""",
    "dwd_increment": """SELECT o_orderkey, o_custkey,
  CASE WHEN o_orderkey > 500 THEN o_totalprice ELSE 0.0 END AS o_totalprice,
  CASE WHEN o_orderkey > 500 THEN o_orderkey ELSE 0 END AS f_ts
FROM orders WHERE (o_orderkey > 500 AND o_orderstatus <> 'F') OR (o_orderkey <= 500 AND o_orderkey % 2 = 0)""",
    "compacted_current": LAKE_WITH_LINEAGE,
    "staged_net_changes": f"""WITH {E.E_SQL}
SELECT id, CASE arg_max(op, event_id) FILTER (WHERE op IN (0, 3))
           WHEN 3 THEN 'delete' WHEN 0 THEN 'upsert' ELSE 'update' END AS action,
  coalesce(arg_max(value, event_id) FILTER (WHERE op IN (0, 2)), -1.0) AS value
FROM e WHERE NOT snap GROUP BY id""",
}
