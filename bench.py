"""Headline timings on local cores; prints one JSON line.

BENCH_SF_DIR   table folder (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default all)
BENCH_RUNS     measured runs after one warm-up (default 5); the median counts
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.operators import decode, fold, quality, reshard, routes as R
from lakesync.plans import sync
from lakesync.session import configure, run_dir
from lakesync.sinks.store import StateStore
from lakesync.sources import envelopes
from lakesync.streaming.sync import SyncJob
from queries import feed as E
from queries import state as Q

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "*")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session() -> SparkSession:
    cores = os.cpu_count() if CPUS == "*" else int(CPUS)
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def run(df: DataFrame) -> None:
    """Compute every column of every row, keep nothing."""
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> list[float]:
    action()
    out = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        out.append(time.perf_counter() - start)
    return out


def land(spark: SparkSession, files: int) -> str:
    """Feed E as landed text files, so that decoding starts from bytes on disk."""
    folder = run_dir(spark, "landing")
    events = E.table(spark, SF_DIR, "events")
    cut = F.pmod(F.col("event_id") * 37, F.lit(files))
    E.event_envelopes(events.repartition(files, cut)).write.text(folder)
    return folder


def main() -> None:
    spark = session()
    cores = spark.sparkContext.defaultParallelism
    landed = land(spark, cores)
    docs = envelopes.read_envelopes(spark, landed)
    routes = E.shop_routes(spark, SF_DIR)
    keyed = E.keyed_routes(spark, SF_DIR)
    orders = E.table(spark, SF_DIR, "orders")
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()

    def typed():
        return quality.accepted(sync.typed_changes(docs, E.EVENT_COLUMNS, routes=routes))

    def states():
        return sync.states(sync.lake_targets(sync.routed_changes(docs, keyed)), 1)

    def migration():
        good = typed()
        old = fold.current(fold.fold(good.where(~F.col(S.CHANGE_ORD)["incremental"]), ["id"]), ["id"], fold.LAKE)
        log = good.where(F.col(S.CHANGE_ORD)["incremental"])
        return fold.apply(old, fold.fold(log, ["id"]), ["id"], fold.MIGRATION)

    def stream(files: int):
        landing = land(spark, files)

        def go():
            root = run_dir(spark, "store")
            job = SyncJob(keyed, root, fold.LAKE, f_ts=1)
            source = envelopes.stream_envelopes(spark, landing, maxFilesPerTrigger="1")
            job.start(source, run_dir(spark, "checkpoint"), interval=None).awaitTermination()

        return go

    def compaction():
        """Base and seven change batches, a new store for every run, built outside the clock."""
        targeted = sync.lake_targets(sync.routed_changes(docs, keyed))
        batches = run_dir(spark, "batches")
        batch = (F.col("pos") * 37 % 8).alias("batch")
        sync.states(targeted.withColumn("dst_table", F.concat("dst_table", F.lit("#"), batch)), 1).write.parquet(batches)
        stored = spark.read.parquet(batches)

        def store():
            out = StateStore(spark, run_dir(spark, "store"))
            for n in range(8):
                part = stored.where(F.endswith("dst_table", F.lit(f"#{n}")))
                out.write_batch(n, part.withColumn("dst_table", F.regexp_replace("dst_table", "#[0-9]$", "")))
                if n == 0:
                    out.compact()
            return out

        stores = [store() for _ in range(RUNS + 1)]
        return lambda: stores.pop().compact()

    def resharded():
        uid = orders.withColumn("Fuid", F.col("o_custkey"))
        return [reshard.with_shard(uid, "Fuid", n) for n in ("TEN", "HUNDRED", "THOUSAND")]

    benches = {
        "decode": lambda: run(decode.decode(docs)),
        "route": lambda: run(R.route(decode.decode(docs), routes)),
        "typed": lambda: run(typed()),
        "fold_lake": lambda: run(fold.current(fold.fold(typed(), ["id"]), ["id"], fold.LAKE)),
        "fold_migration": lambda: run(migration()),
        "fold_all_targets": lambda: run(states()),
        "lake_current": lambda: run(Q.lake_current(spark, SF_DIR)),
        "change_history": lambda: run(Q.change_history(spark, SF_DIR)),
        "reshard": lambda: [run(x) for x in resharded()],
        "key_delete": lambda: run(Q.key_delete(spark, SF_DIR)),
        "stream_1": stream(1),
        "stream_7": stream(7),
        "compaction": compaction(),
    }
    times = {name: timed(action) for name, action in benches.items()}
    medians = {name: round(statistics.median(t), 4) for name, t in times.items()}
    print(
        json.dumps(
            {
                "metric": "total median seconds of the headline queries",
                "value": round(sum(medians.values()), 4),
                "unit": "sec",
                "queries": medians,
                "spread": {name: [round(min(t), 4), round(max(t), 4)] for name, t in times.items()},
                "decode_rows_per_sec": round(events / medians["decode"]),
                "fold_rows_per_sec": round(events / medians["fold_lake"]),
                "runs": RUNS,
                "cores": cores,
                "spark": spark.version,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
