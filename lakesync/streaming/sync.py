"""The continuous job: one streaming query for all instances and tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakesync import files, schemas as S
from lakesync.operators import ddl, decode, fold, quality
from lakesync.operators.routes import check_routes
from lakesync.operators.typed import rejected, sync_time
from lakesync.plans import sync
from lakesync.session import BROADCAST_ROWS, checkpointed
from lakesync.sinks import queue
from lakesync.sinks.store import StateStore
from lakesync.sinks.typed import TypedTable
from lakesync.sources import catalog

# Fixed value: default commit cadence.
COMMIT_INTERVAL = "5 seconds"


@dataclass
class SyncJob:
    """Applies micro-batches of envelopes to a store below `root`.

    Every output of a batch goes to a folder named by the batch id and replaces it, and
    state rows merge by log position, so a repeated batch, or one that arrives late,
    changes nothing. Root and streaming checkpoint belong together: batch ids count from
    the start of the checkpoint, and a store refuses the batches of another query.

    `allow` names route problems to accept (see routes.route_collisions); with
    "several_instances" the instance becomes part of the keys of sharded lake targets.
    `logs` orders the logs of an instance that has had several (see decode.continued);
    without it, a second log of an instance stops the job. `typed` names targets that are
    kept as typed tables too (see TypedTable); each is merged by a job of its own, and with
    `send_differences` the rows before and after of each batch's touched keys are written first.
    """

    routes: DataFrame
    root: str
    profile: str = fold.LAKE
    env: str = "PROD"
    application: str = ""
    send_messages: bool = False
    drop_deletes: bool = False
    f_ts: Column | int | None = None
    write_messages: Callable[[DataFrame, str], None] = queue.write_files
    allow: Sequence[str] = ()
    logs: DataFrame | None = None
    typed: Sequence[TypedTable] = ()
    send_differences: bool = False
    seen_logs: dict[str, str] = field(default_factory=dict, repr=False)

    def __post_init__(self):
        # Written once: a batch must not read the catalog again, and all batches see the routes checked here.
        self.routes = checkpointed(self.routes)
        check_routes(self.routes, self.allow)
        keyless = catalog.keyless(self.routes, lake=self.profile == fold.LAKE)
        some = keyless.limit(10).collect()
        if some:
            names = ", ".join(f"{r['src_db']}.{r['src_table']}" for r in some)
            raise ValueError(f"{keyless.count()} tables without a key: {names}")
        # Of very many routes, each batch takes those that it names.
        self.many_routes = self.routes.limit(BROADCAST_ROWS + 1).count() > BROADCAST_ROWS
        self.known = sync.key_names(self.routes)
        self.routes = self.routes if self.many_routes else F.broadcast(self.routes)
        if self.logs is not None:
            self.logs = checkpointed(self.logs)
        for target in self.typed:
            target.create()

    def check_logs(self, changes: DataFrame) -> None:
        """Without `logs`, an instance has one log; a row per instance comes to the driver."""
        named = changes.where((F.trim("file") != "") & F.col("instance").isNotNull())
        base = decode.log_base(F.col("file"))
        for r in named.groupBy("instance").agg(F.min(base).alias("first"), F.max(base).alias("last")).collect():
            known = self.seen_logs.setdefault(r["instance"], r["first"])
            if {r["first"], r["last"]} != {known}:
                other = r["last"] if r["last"] != known else r["first"]
                raise ValueError(f"instance {r['instance']} has a second log {other!r} after {known!r}: list its logs in `logs`")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """One micro-batch of envelope text in column `value`."""
        routed = sync.routed_changes(batch, self.routes, check_size=self.many_routes, logs=self.logs, known=self.known)
        targeted = sync.targets(routed, self.profile, "several_instances" in self.allow).persist()
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or ""
        try:
            if self.logs is None:
                self.check_logs(targeted)
            log, blank = ddl.capture(targeted)
            if not log.isEmpty():  # most batches have none
                log.write.mode("overwrite").parquet(f"{self.root}/ddl_log/batch_id={batch_id}")
            bad = quality.quarantined(targeted.unionByName(blank)).select(*S.QUARANTINE_COLUMNS)
            bad.write.mode("overwrite").parquet(f"{self.root}/quarantine/batch_id={batch_id}")
            rows = targeted.where(F.col(S.REASON).isNull())
            if self.send_messages:
                out = queue.messages(rows, self.env)
                self.write_messages(out, f"{self.root}/messages/batch_id={batch_id}")
            if self.drop_deletes:
                audit = quality.delete_audit(rows, self.application)
                audit.write.mode("overwrite").parquet(f"{self.root}/deletes/batch_id={batch_id}")
                rows = quality.without_deletes(rows)
            stamp = self.f_ts if self.f_ts is not None else sync_time()
            StateStore(batch.sparkSession, self.root).write_batch(batch_id, sync.states(rows, stamp), query)
            self.merge_typed(rows, stamp, batch_id)
        finally:
            targeted.unpersist()

    def merge_typed(self, rows: DataFrame, stamp: Column | int, batch_id: int) -> None:
        """Bring the typed targets up to the batch; rows that do not fit go to the quarantine of typed rows."""
        for target in self.typed:
            named = (F.col("dst_db") == target.db) & (F.col("dst_table") == target.table)
            own = rows.where(named & (F.col("op") != S.DDL))
            bad = rejected(own, target.columns, lineage=target.lineage)
            bad.write.mode("overwrite").parquet(f"{self.root}/quarantine_typed/{target.db}.{target.table}/batch_id={batch_id}")
            # Written and not cached: later steps split them by their size, a cached aggregation keeps its partitions.
            path = f"{self.root}/net/{target.db}.{target.table}/batch_id={batch_id}"
            net = target.states(own, stamp)
            net.write.mode("overwrite").parquet(path)
            states = rows.sparkSession.read.schema(net.schema).parquet(path)
            try:
                sizes = target.sizes(states)
                out = f"{self.root}/differences/{target.db}.{target.table}/batch_id={batch_id}"
                # A batch that comes again finds itself in the target; what it wrote the first time stays.
                if self.send_differences and not files.exists(rows.sparkSession, f"{out}/_SUCCESS"):
                    target.differences(states, sorted(sizes), target.fits(sizes)).write.mode("overwrite").parquet(out)
                target.merge(states, sizes)
            finally:
                files.delete(rows.sparkSession, path)

    def start(
        self, envelopes: DataFrame, checkpoint: str, *, interval: str | None = COMMIT_INTERVAL
    ) -> StreamingQuery:
        """Run continuously, or with `interval=None` until the available input is done."""
        trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
        return (
            envelopes.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .start()
        )
