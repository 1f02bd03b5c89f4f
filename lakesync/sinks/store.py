"""Keyed tables on plain parquet: change batches, a base, fold on read.

Layout below the root:
  changes/batch_id=N/dst_db=../dst_table=..   state rows of one batch
  base/version=V/dst_db=../dst_table=..       compacted state rows
  commits/batch_id=N                          marks a complete batch
  versions/version=V                          marks a complete compaction, the versions that
                                              are live after it and the batches they hold

A batch overwrites its own folder, so a retry changes nothing, and counts only once
its commit exists. Many targets share one store and one write: there is no query
object, sink or task per table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync import schemas as S
from lakesync.functions.types import ColumnSpec
from lakesync.operators import fold
from lakesync.operators.ddl import Evolution, evolved_rows
from lakesync.operators.quality import accepted
from lakesync.operators.typed import rejected, typed_rows

KEYS = ("dst_db", "dst_table", "key")
_ORD = "struct<incremental: boolean, file_no: bigint, pos: bigint, row_no: int>"
_IMAGE = "struct<row: variant, db: string, table: string, f_ts: bigint>"
STATE_SCHEMA = (
    f"key array<string>, anchor_op tinyint, anchor_ord {_ORD}, image {_IMAGE}, image_ord {_ORD}, "
    f"last_op tinyint, last_ord {_ORD}, last_ts bigint, dst_db string, dst_table string"
)


class StateStore:
    """State rows of many keyed targets below one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- writing --

    def write_batch(self, batch_id: int, states: DataFrame, query: str = "") -> None:
        """Store one batch; the same id replaces the same batch.

        `query` names the streaming query that counts the ids. A store that holds batches of
        another query would take new ids for old ones, so it refuses.
        """
        owners = {r["query"] or "" for r in self._read_marks("commits", "query string")}
        owners |= {r["query"] or "" for r in self._read_marks("versions", "query string")}
        others = sorted(o for o in owners if o and query and o != query)
        if others:
            raise ValueError(f"store {self.root} holds batches of query {others[0]}, not of {query}")
        self._write(states, f"{self.root}/changes/batch_id={batch_id}")
        self._mark(f"{self.root}/commits/batch_id={batch_id}", {"batch": batch_id, "query": query})

    def compact(self, *, full: bool = True, drop_deleted_before: tuple[int, int] | None = None) -> int:
        """Fold committed batches into a new version and publish it.

        A full compaction rewrites base and batches into one base. Otherwise only the
        batches are folded, next to the base, so frequent compactions cost what arrived
        and not what is stored.

        Deleted keys stay as markers so that a late older change cannot revive them; a
        full compaction may drop markers below a log position (file number, position)
        once nothing older can arrive.
        """
        if drop_deleted_before is not None and not full:
            raise ValueError("only a full compaction may drop markers")
        published, batches = self._published(), self.batches()
        version = published["version"] + 1
        states = self.states() if full else fold.merge(self._batch_states(batches), KEYS)
        if drop_deleted_before is not None:
            file_no, pos = drop_deleted_before
            bound = F.struct(F.lit(file_no).cast("bigint").alias("a"), F.lit(pos).cast("bigint").alias("b"))
            at = F.struct(F.col("last_ord.file_no").alias("a"), F.col("last_ord.pos").alias("b"))
            states = states.where(~((F.col("last_op") == S.DELETE) & (at < bound)))
        self._write(states, f"{self.root}/base/version={version}")
        owners = [r["query"] for kind in ("commits", "versions") for r in self._read_marks(kind, "query string") if r["query"]]
        mark = {
            "query": owners[0] if owners else "",
            "version": version,
            "live": _runs([version], [] if full else published["live"]),
            "folded": _runs(batches, published["folded"]),
        }
        self._mark(f"{self.root}/versions/version={version}", mark)
        return version

    def expire(self) -> list[str]:
        """Delete folded batches and versions that are no longer live; returns the folders.

        Run it once no reader of an older version is left. What is deleted stays known
        as folded, so a batch repeated later is not read again.
        """
        published = self._published()
        version, live = published["version"], published["live"]

        def folded(n: int) -> bool:
            return _holds(published["folded"], n)

        dead = {
            "changes": folded,
            "commits": folded,
            "base": lambda n: n <= version and not _holds(live, n),
            "versions": lambda n: n < version,
        }
        removed = []
        for kind, is_dead in dead.items():
            for name in self._children(kind):
                if is_dead(int(name.rsplit("=", 1)[1])):
                    self._delete(f"{kind}/{name}")
                    removed.append(f"{kind}/{name}")
        return removed

    # -- reading --

    def batches(self) -> list[int]:
        """Committed batches that no version holds."""
        folded = self._published()["folded"]
        done = {r["batch"] for r in self._read_marks("commits", "batch bigint")}
        return sorted(b for b in done if not _holds(folded, b))

    def raw_states(self) -> DataFrame:
        """Live versions and batches, several rows per key."""
        live = [v for first, last in self._published()["live"] for v in range(first, last + 1)]
        batches = self._batch_states(self.batches())
        if not live:
            return batches
        return self._load("base", [f"version={v}" for v in live], "version").unionByName(batches)

    def states(self, dst_db: str | None = None, dst_table: str | None = None) -> DataFrame:
        """One state row per key; a target given by name is read from its folders only.

        A single base with no batch behind it has one row per key already, so nothing is merged.
        """
        raw = self.raw_states()
        live = self._published()["live"]
        single = [last - first for first, last in live] == [0] and not self.batches()
        if dst_db is not None:
            raw = raw.where(F.col("dst_db") == dst_db)
        if dst_table is not None:
            raw = raw.where(F.col("dst_table") == dst_table)
        return raw if single else fold.merge(raw, KEYS)

    def current(
        self,
        dst_db: str,
        dst_table: str,
        columns: Sequence[ColumnSpec],
        profile: str,
        *,
        lineage: bool = False,
        sync_time: bool = False,
        **typed_options,
    ) -> DataFrame:
        """Typed current rows of one target; `current_rejected` has the rows that do not fit."""
        stamp = F.col("f_ts") if sync_time else None
        rows = self.current_images(dst_db, dst_table, profile).select("image.*")
        return accepted(typed_rows(rows, columns, lineage=lineage, f_ts=stamp, **typed_options))

    def deleted_keys(
        self, dst_db: str, dst_table: str, columns: Sequence[ColumnSpec], profile: str, since: int, *, lineage: bool = False
    ) -> DataFrame:
        """Typed keys of a target that were deleted after a sync time: what an increment has to take away downstream."""
        names = fold.key_columns(columns, lake=profile == fold.LAKE, sharded=lineage)
        types = {c.name: c.spark_type() for c in columns}
        gone = self.states(dst_db, dst_table).where((fold.action(profile) == fold.REMOVE) & (F.col("last_ts") > since))
        return gone.select(*[F.get("key", F.lit(i)).try_cast(types.get(n, "string")).alias(n) for i, n in enumerate(names)])

    def current_rejected(
        self, dst_db: str, dst_table: str, columns: Sequence[ColumnSpec], profile: str, **typed_options
    ) -> DataFrame:
        """Current rows of a target with a value its type cannot hold, whole, with the reason."""
        rows = self.current_images(dst_db, dst_table, profile).select("image.*")
        return rejected(rows, columns, **typed_options)

    def current_images(self, dst_db: str, dst_table: str, profile: str) -> DataFrame:
        """State rows of the rows that exist."""
        return self.states(dst_db, dst_table).where(fold.action(profile) == fold.UPSERT)

    def current_evolved(self, dst_db: str, dst_table: str, evolution: Evolution, profile: str) -> DataFrame:
        """Current rows of a target whose schema changed, old rows in the new layout."""
        live = self.current_images(dst_db, dst_table, profile).select("image.row", "image_ord")
        position = F.struct("image_ord.file_no", "image_ord.pos")
        return accepted(evolved_rows(live, evolution, position=position))

    # -- files --

    def _write(self, states: DataFrame, path: str) -> None:
        # Rebalancing splits a hot target over many files and packs small ones together.
        spread = states.hint("rebalance", "dst_db", "dst_table")
        spread.write.mode("overwrite").partitionBy("dst_db", "dst_table").parquet(path)

    def _load(self, kind: str, folders: list[str], tag: str) -> DataFrame:
        base = f"{self.root}/{kind}"
        schema = f"{STATE_SCHEMA}, {tag} bigint"
        read = self.spark.read.schema(schema).option("basePath", base)
        return read.parquet(*[f"{base}/{f}" for f in folders]).drop(tag)

    def _batch_states(self, batches: list[int]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], STATE_SCHEMA)
        return self._load("changes", [f"batch_id={b}" for b in batches], "batch_id")

    def _mark(self, path: str, fields: dict) -> None:
        columns = [_literal(v).alias(k) for k, v in fields.items()]
        self.spark.range(1, numPartitions=1).select(*columns).write.mode("overwrite").json(path)

    def _read_marks(self, kind: str, schema: str) -> list:
        if not self._children(kind):
            return []
        return self.spark.read.schema(schema).json(f"{self.root}/{kind}/*").collect()

    def _published(self) -> dict:
        """The last complete compaction: its version, and runs of live versions and folded batches."""
        marks = self._read_marks(
            "versions", "version bigint, live array<array<bigint>>, folded array<array<bigint>>"
        )
        if not marks:
            return {"version": 0, "live": [], "folded": []}
        last = max(marks, key=lambda r: r["version"])
        return {k: [list(run) for run in last[k]] if k != "version" else last[k] for k in ("version", "live", "folded")}

    def _path(self, path: str):
        jvm = self.spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), p

    def _children(self, kind: str) -> list[str]:
        """Names of the numbered folders of a kind."""
        fs, p = self._path(f"{self.root}/{kind}")
        names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
        return [n for n in names if "=" in n]

    def _delete(self, path: str) -> None:
        fs, p = self._path(f"{self.root}/{path}")
        fs.delete(p, True)


def _holds(runs: list[list[int]], n: int) -> bool:
    return any(first <= n <= last for first, last in runs)


def _runs(numbers: list[int], runs: list[list[int]] = ()) -> list[list[int]]:
    """Numbers and [first, last] runs as few runs; ids grow by one, so there are few."""
    out: list[list[int]] = []
    for first, last in sorted([*([n, n] for n in numbers), *(list(r) for r in runs)]):
        if out and first <= out[-1][1] + 1:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return out


def _literal(value):
    if isinstance(value, list):
        runs = [F.array(*[F.lit(x).cast("bigint") for x in run]) for run in value]
        return F.array(*runs).cast("array<array<bigint>>")
    return F.lit(value) if isinstance(value, str) else F.lit(value).cast("bigint")
