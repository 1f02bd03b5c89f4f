"""The continuous job over landed files: same results as batch, in any cut of the feed."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.operators import fold, quality
from lakesync.plans import layers, sync
from lakesync.session import checkpointed, run_dir, stored
from lakesync.sinks.store import StateStore
from lakesync.sinks.typed import TypedTable
from lakesync.sources import envelopes
from lakesync.streaming import state
from lakesync.streaming.sync import SyncJob
from queries import feed as E
from queries.state import LAKE_WITH_LINEAGE, RESULT


# Files a micro-batch takes: they are written in parallel.
PER_BATCH = 8
ONE_BATCH = {"maxFilesPerTrigger": str(PER_BATCH)}


def land(spark, sf_dir, folder: str, batches: int) -> None:
    """Write the feed as landed files for so many micro-batches of equal size, in an order that is not log order."""
    events = E.table(spark, sf_dir, "events")
    files = batches * PER_BATCH
    # The number of the partition itself: its hash would put several parts into one file.
    cut = F.pmod(F.col("event_id") * 37, F.lit(files)).cast("int")
    E.event_envelopes(events.repartitionById(files, cut)).write.mode("overwrite").text(folder)


def run_job(spark, sf_dir, batches: int, profile: str, **options):
    """Land, stream batch by batch until done, and return the job."""
    root = run_dir(spark, "stream")
    land(spark, sf_dir, f"{root}/landing", batches)
    job = SyncJob(E.keyed_routes(spark, sf_dir), f"{root}/store", profile, f_ts=1_700_000_000_000, **options)
    docs = envelopes.stream_envelopes(spark, f"{root}/landing", **ONE_BATCH)
    job.start(docs, f"{root}/checkpoint", interval=None).awaitTermination()
    return job


def stream_lake_current(spark, sf_dir):
    """Lake job in seven micro-batches, with messages and audit on."""
    job = run_job(spark, sf_dir, 7, fold.LAKE, send_messages=True)
    rows = StateStore(spark, job.root).current(
        "shop_db", "t_event", E.EVENT_COLUMNS, fold.LAKE, lineage=True, sync_time=True
    )
    return E.event_result(rows, S.DB_NAME, S.TABLE_NAME, S.SYNC_TS)


def stream_migration_current(spark, sf_dir):
    """Migration job in two micro-batches, the first one replayed at the end."""
    job = run_job(spark, sf_dir, 2, fold.MIGRATION)
    store = StateStore(spark, job.root)
    replay = envelopes.read_envelopes(spark, job.root.replace("/store", "/landing"))
    job.process(replay, 99)
    return E.event_result(store.current("shop_db", "t_event", E.EVENT_COLUMNS, fold.MIGRATION))


def stream_messages(spark, sf_dir):
    """Messages the job wrote, by topic and operation."""
    job = run_job(spark, sf_dir, 2, fold.LAKE, send_messages=True, env="TEST")
    files = spark.read.schema("key string, value string, topic string").json(f"{job.root}/messages")
    op = F.get_json_object("value", "$.op").cast("bigint")
    return files.groupBy("topic", op.alias("op")).agg(
        F.count(F.lit(1)).alias("messages"),
        F.sum(F.get_json_object("value", "$.row.id").cast("bigint")).alias("ids"),
    )


def stream_quarantine(spark, sf_dir):
    """Job under rules that leave tables out: what was set aside, and deletes audited."""
    root = run_dir(spark, "stream")
    land(spark, sf_dir, f"{root}/landing", 2)
    job = SyncJob(E.keyed_routes(spark, sf_dir, E.MIXED_RULES), f"{root}/store", drop_deletes=True, application="ods")
    docs = envelopes.stream_envelopes(spark, f"{root}/landing")
    job.start(docs, f"{root}/checkpoint", interval=None).awaitTermination()
    bad = spark.read.parquet(f"{job.root}/quarantine").groupBy(F.col("reason").alias("kind"), "db", "table")
    audit = spark.read.parquet(f"{job.root}/deletes").groupBy(F.lit("deleted").alias("kind"), "db", "table")
    count = F.count(F.lit(1)).alias("rows")
    return bad.agg(count).unionByName(audit.agg(count))


def stream_state_current(spark, sf_dir):
    """The fold as a streaming aggregation over the events table itself."""
    root = run_dir(spark, "state")
    events = E.table(spark, sf_dir, "events")
    stream = (
        spark.readStream.schema(events.schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    )
    typed = quality.accepted(sync.typed_changes(E.event_envelopes(stream), E.EVENT_COLUMNS))
    state.stream_states(typed, ["id"], f"{root}/states", f"{root}/checkpoint").awaitTermination()
    states = state.read_states(spark, f"{root}/states", ["id"])
    return E.event_result(fold.current(states, ["id"], fold.LAKE))


def typed_target(spark, root, **options):
    return TypedTable(spark, f"typed_{uuid.uuid4().hex}", "t_event", E.EVENT_COLUMNS, lineage=True, location=f"{root}/typed", **options)


def stream_lake_typed(spark, sf_dir):
    """Lake job in three micro-batches into a typed table in buckets, the first batch replayed at the end."""
    root = run_dir(spark, "stream")
    target = typed_target(spark, root, buckets=16)
    rules = [replace(E.SHOP_RULES[0], target=target.db)]
    land(spark, sf_dir, f"{root}/landing", 3)
    job = SyncJob(E.keyed_routes(spark, sf_dir, rules), f"{root}/store", f_ts=1_700_000_000_000, typed=[target])
    docs = envelopes.stream_envelopes(spark, f"{root}/landing", **ONE_BATCH)
    job.start(docs, f"{root}/checkpoint", interval=None).awaitTermination()
    job.process(envelopes.read_envelopes(spark, f"{root}/landing"), 99)
    return E.event_result(target.current(), S.DB_NAME, S.TABLE_NAME, S.SYNC_TS)


def stream_differences_current(spark, sf_dir):
    """Rows before and after that seven micro-batches gave out, added up: the last one of each key is the state."""
    root = run_dir(spark, "stream")
    target = typed_target(spark, root, buckets=8)
    rules = [replace(E.SHOP_RULES[0], target=target.db)]
    land(spark, sf_dir, f"{root}/landing", 7)
    job = SyncJob(E.keyed_routes(spark, sf_dir, rules), f"{root}/store", f_ts=1_700_000_000_000, typed=[target], send_differences=True)
    docs = envelopes.stream_envelopes(spark, f"{root}/landing", **ONE_BATCH)
    job.start(docs, f"{root}/checkpoint", interval=None).awaitTermination()
    given = spark.read.parquet(f"{root}/store/differences/{target.db}.{target.table}")
    last = given.groupBy(*target.keys).agg(F.max_by("after", "batch_id").alias("after"))
    whole = last.where("after is not null").select(*target.keys, "after.*")
    return E.event_result(whole, S.DB_NAME, S.TABLE_NAME, S.SYNC_TS)


def typed_increment(spark, sf_dir):
    """A downstream table from two increments of a typed table, whose filter on the sync time reaches the files."""
    target = typed_target(spark, run_dir(spark, "typed"), buckets=8)
    target.create()
    routed = sync.routed_changes(E.feed(spark, sf_dir), E.keyed_routes(spark, sf_dir))
    early = ~F.col("incremental") | (F.col("pos") < 500)
    # Decoded and typed once for both parts, whose sync times tell them apart; a merge takes net changes that are stored.
    typed = stored(target.typed(routed, F.when(early, 1).otherwise(2)), "typed-changes")
    target.merge(stored(target.net(typed.where(F.col(S.SYNC_TS) == 1)), "net"))
    dwd = checkpointed(target.current().drop(S.SYNC_TS))
    target.merge(stored(target.net(typed.where(F.col(S.SYNC_TS) == 2)), "net"))
    ods = target.current(since=1).withColumn(S.IS_DEL, F.lit(0))
    return E.event_result(layers.clean_apply(dwd, ods, target.keys, gone=target.deleted(since=1)), S.DB_NAME, S.TABLE_NAME)


QUERIES = {
    "stream_lake_typed": stream_lake_typed,
    "stream_differences_current": stream_differences_current,
    "typed_increment": typed_increment,
    "stream_lake_current": stream_lake_current,
    "stream_migration_current": stream_migration_current,
    "stream_messages": stream_messages,
    "stream_quarantine": stream_quarantine,
    "stream_state_current": stream_state_current,
}

ORACLE = {
    "stream_lake_typed": LAKE_WITH_LINEAGE,
    "stream_differences_current": LAKE_WITH_LINEAGE,
    "typed_increment": f"WITH {E.lake_sql()} SELECT db AS db_name, tbl AS table_name, {RESULT} FROM cur",
    "stream_lake_current": LAKE_WITH_LINEAGE,
    "stream_migration_current": f"WITH {E.migration_sql()} SELECT {RESULT} FROM cur",
    "stream_messages": f"""WITH {E.E_SQL} SELECT 'flink.test.shop_db.t_event' AS topic, CAST(op AS BIGINT) AS op,
  count(*) AS messages, CAST(sum(id) AS BIGINT) AS ids FROM e WHERE NOT snap GROUP BY ALL""",
    "stream_quarantine": f"""WITH {E.E_SQL},
k AS (SELECT *, (user_id % 4 = 0 AND user_id % 10 IN (0, 4)) OR (user_id % 4 IN (1, 2) AND user_id % 10 <> 9) AS ok FROM e)
SELECT 'unrouted' AS kind, db, tbl AS table, count(*) AS rows FROM k WHERE NOT ok GROUP BY ALL
UNION ALL SELECT 'deleted', db, tbl, count(*) FROM k WHERE ok AND op = 3 GROUP BY ALL""",
    "stream_state_current": f"WITH {E.lake_sql()} SELECT {RESULT} FROM cur",
}
