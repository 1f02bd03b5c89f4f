"""Conversation prefix trie: which beginnings conversations share, and what sharing them would save.

A conversation is a path: 20 bytes a turn, the MD5 of its role and text and its code points, so that
equal turns are equal bytes and a path sorts next to those that begin like it. Equal paths become
one row, with their number, before anything is sorted. Splitters, shortened paths of a bounded
sample, cut the sorted paths into shards. A node that is a proper prefix of a splitter may have
members in several shards; these nodes are the skeleton, which is as small as the splitters and
broadcast. Every other node lies in one shard: a task that walks its sorted paths with a stack
finishes it there. For a skeleton node each shard gives a partial aggregate, and what they and the
skeleton nodes below add up to is a reduction over shards and ancestors.

The members that end at a node are hashed in ascending order from blocks of joined ids, which range
partitions of (node, conv_id) make; no list of them is ever one row or one task's memory.

Rows: a null role or text is empty; rows of a null conv_id are no conversation and left out. Turns go
by turn, null first; those of one turn by the MD5 of role and text, and a row that occurs twice is
two turns. An empty table has no nodes, not even a root. Other columns are ignored. A path is
held as one value (a conversation of a million turns is 20 MB); its texts are not.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import written

TURN = 20
# Conversations of one base, and turns taken from it at most.
FAMILY, SHARED = 100, 5
# Paths looked at for a splitter, and their turns looked at; bounds the driver's sample, not the result.
LOOKED, TURNS_LOOKED = 8, 256
# Ids joined to a block, rows given out at a time.
BLOCK, ROWS = 1 << 14, 1 << 13

NODES = "skel int, conv_id long, depth long, parent_skel int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"


def turn_key() -> Column:
    """40 hex digits that stand for role and text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    told = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    return F.concat(told, F.lpad(F.hex(F.length(text)), 8, "0"))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): keys of the turns of each conversation, in order."""
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(F.col("turn").cast("long").alias("turn"), turn_key().alias("key")).alias("one"),
    )
    ordered = F.sort_array(F.collect_list("one"))
    return turns.groupBy("conv_id").agg(F.transform(ordered, lambda t: t["key"]).alias("turns"))


def rebuilt(own: DataFrame) -> DataFrame:
    """Each conversation with its first crc32(conv_id) % (SHARED + 1) turns from its family's base."""
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (SHARED + 1)).cast("int")
    bases = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, SHARED).alias("head")
    )
    known = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % FAMILY).join(bases, "base", "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), taken)
    tail = F.slice("turns", taken + 1, F.size("turns"))
    return known.select("conv_id", F.concat(head, tail).alias("turns"))


def paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, path)."""
    return sequences.select("conv_id", F.unhex(F.array_join("turns", "")).alias("path"))


def end_hashes(members: DataFrame, parts: int) -> DataFrame:
    """(first, ends): SHA-256 of the ascending conv_ids of each value of `first`."""

    def blocks(batches):
        """Runs of ids of one `first`, joined; a run may be cut anywhere."""
        for batch in batches:
            rows = zip(batch.column("first").to_pylist(), batch.column("conv_id").to_pylist())
            out = []
            for first, run in groupby(rows, itemgetter(0)):
                ids = [i for _, i in run]
                out += [(first, ids[k], ",".join(map(str, ids[k : k + BLOCK]))) for k in range(0, len(ids), BLOCK)]
            yield record(out, "first long, begin long, ids string")

    def digests(batches):
        now, sha = None, None
        for batch in batches:
            out = []
            for first, ids in zip(batch.column("first").to_pylist(), batch.column("ids").to_pylist()):
                if sha and first == now:
                    sha.update(b"," + ids.encode())
                    continue
                if sha:
                    out.append((now, sha.hexdigest()))
                now, sha = first, hashlib.sha256(ids.encode())
            yield record(out, "first long, ends string")
        if sha:
            yield record([(now, sha.hexdigest())], "first long, ends string")

    ranged = members.repartitionByRange(parts, "first", "conv_id").sortWithinPartitions("first", "conv_id")
    joined = ranged.mapInArrow(blocks, "first long, begin long, ids string")
    return joined.repartition(parts, "first").sortWithinPartitions("first", "begin").mapInArrow(digests, "first long, ends string")


def record(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    fields = [f.split() for f in schema.split(", ")]
    columns = zip(*rows) if rows else [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def shared_turns(a: bytes, b: bytes) -> int:
    """Turns with which both paths begin."""
    most = min(len(a), len(b)) // TURN
    if a[: most * TURN] == b[: most * TURN]:
        return most
    low, high = 0, most
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[: middle * TURN] == b[: middle * TURN] else (low, middle)
    return low


def splitters(distinct: DataFrame, shards: int) -> list[bytes]:
    """At most shards - 1 ascending paths that cut a fixed pseudorandom sample of the paths into equal parts.

    Each is shortened to the first turn that tells it from the sampled path before it.
    """
    looked = distinct.select(F.expr(f"substring(path, 1, {TURNS_LOOKED * TURN})").alias("path"), F.xxhash64("path").alias("at"))
    sample = sorted({bytes(r.path) for r in looked.orderBy("at", "path").limit(LOOKED * shards).collect()})
    out = []
    for k in sorted({len(sample) * i // shards for i in range(1, shards)} - {0}):
        out.append(sample[k][: (shared_turns(sample[k - 1], sample[k]) + 1) * TURN])
    return out


def skeleton_of(cuts: list[bytes]) -> dict[bytes, int]:
    """All proper prefixes of the splitters, and the root, numbered in order."""
    return {p: i for i, p in enumerate(sorted({b"", *(c[:k] for c in cuts for k in range(0, len(c), TURN))}))}


def skeleton_rows(skeleton: dict[bytes, int]) -> list[tuple[int, int, int, int, list[int]]]:
    """(skel, parent, own code points, skeleton children, ancestors and itself)."""
    children = dict.fromkeys(skeleton, 0)
    for p in skeleton:
        if p:
            children[p[:-TURN]] += 1
    return [
        (i, skeleton[p[:-TURN]] if p else None, code_points(p), children[p], [skeleton[p[:k]] for k in range(0, len(p) + 1, TURN)])
        for p, i in skeleton.items()
    ]


def code_points(path: bytes) -> int:
    """Those of the last turn."""
    return int.from_bytes(path[-4:], "big")


class Node:
    """An open node of the walk; `first` is its smallest member so far."""

    __slots__ = ("skel", "size", "n", "first", "children", "leaves", "saved", "ends", "waiting")

    def __init__(self, skel: int | None, size: int):
        self.skel, self.size = skel, size
        self.n = self.children = self.leaves = self.saved = 0
        self.first = self.ends = None
        # Finished children, which lack the smallest member of this node.
        self.waiting: list[tuple] = []

    def seen(self, n: int, first: int) -> None:
        self.n += n
        self.first = first if self.first is None else min(self.first, first)


def walked(rows, skeleton: dict[bytes, int]) -> Iterator[tuple]:
    """Nodes (NODES) of ascending distinct paths (path, first, n, ends): finished ones, and partial ones of the skeleton."""
    stack: list[Node] = []
    before = b""

    def closed() -> Iterator[tuple]:
        node, depth = stack.pop(), len(stack)
        above = stack[-1] if stack else None
        if above:
            above.seen(node.n, node.first)
        if node.skel is not None:
            if above:
                above.leaves += node.leaves
                above.saved += node.saved
            yield (node.skel, node.first, depth, None, None, node.n, node.children, node.leaves, node.saved, node.ends)
            return
        leaves = node.leaves or 1
        saved = node.saved + (node.n - 1) * node.size
        above.children += 1
        above.leaves += leaves
        above.saved += saved
        for child in node.waiting:
            yield (*child[:4], node.first, *child[5:])
        done = (None, node.first, depth, above.skel, None, node.n, node.children, leaves, saved, node.ends)
        if above.skel is None:
            above.waiting.append(done)
        else:
            yield done

    for path, first, n, ends in rows:
        if not stack:
            stack.append(Node(skeleton[b""], 0))
        common = shared_turns(before, path)
        while len(stack) - 1 > common:
            yield from closed()
        for end in range(len(stack) * TURN, len(path) + 1, TURN):
            prefix = path[:end] if stack[-1].skel is not None else None
            stack.append(Node(skeleton.get(prefix), code_points(path[end - TURN : end])))
        stack[-1].seen(n, first)
        stack[-1].ends = ends or hashlib.sha256(str(first).encode()).hexdigest()
        before = path
    while stack:
        yield from closed()


def trie(paths: DataFrame) -> DataFrame:
    """All nodes of the paths (conv_id, path), one row each."""
    spark = paths.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stored = written(paths, "trie-paths")
    distinct = written(stored.groupBy("path").agg(F.min("conv_id").alias("first"), F.count("*").alias("n")), "trie-distinct")
    members = written(stored.join(distinct.where("n > 1").select("path", "first"), "path").select("first", "conv_id"), "trie-members")
    ended = distinct.join(end_hashes(members, parts), "first", "left").select("path", "first", "n", "ends")

    cuts = splitters(distinct, parts)
    skeleton = skeleton_of(cuts)
    shared = spark.sparkContext.broadcast((cuts, skeleton))

    def dealt(batches):
        for batch in batches:
            cuts = shared.value[0]
            shard = [bisect_right(cuts, p) for p in batch.column("path").to_pylist()]
            yield batch.append_column("shard", pa.array(shard, pa.int32()))

    def run(batches):
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("path", "first", "n", "ends")))

        out = []
        for node in walked(rows(), shared.value[1]):
            out.append(node)
            if len(out) == ROWS:
                yield record(out, NODES)
                out = []
        yield record(out, NODES)

    sharded = ended.mapInArrow(dealt, "path binary, first long, n long, ends string, shard int")
    sharded = sharded.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("path")
    nodes = written(sharded.select("path", "first", "n", "ends").mapInArrow(run, NODES), "trie-nodes")

    # As many rows as the skeleton has nodes, which the splitters bound.
    frame = spark.createDataFrame(skeleton_rows(skeleton), "skel int, up int, size long, inner int, line array<int>")
    whole = (
        nodes.where("skel is not null")
        .groupBy("skel", "depth")
        .agg(
            F.min("conv_id").alias("conv_id"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")],
            F.max("ends").alias("ends"),
        )
        .join(F.broadcast(frame), "skel")
    )
    whole = written(whole, "trie-skeleton")
    below = whole.select(F.explode("line").alias("skel"), ((F.col("n_convs") - 1) * F.col("size")).alias("inside"))
    below = below.groupBy("skel").agg(F.sum("inside").alias("inside"))
    ids = whole.select(F.col("skel").alias("up"), F.col("conv_id").alias("up_id"))
    inner = (
        whole.join(below, "skel")
        .join(ids, "up", "left")
        .select("conv_id", "depth", F.col("up_id").alias("parent_conv_id"), "n_convs", (F.col("n_children") + F.col("inner")).alias("n_children"),
                "n_leaves", (F.col("saved") + F.col("inside")).alias("saved"), "ends")
    )
    outer = nodes.where("skel is null").join(F.broadcast(ids), F.col("parent_skel") == F.col("up"), "left")
    outer = outer.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "up_id")).select(inner.columns)
    # A node at which nobody ends has the hash of nothing.
    none = F.lit(hashlib.sha256().hexdigest())
    return inner.unionByName(outer).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", none).alias("ends_sha256"),
    )


def rebuilt_trie(conversations: DataFrame) -> DataFrame:
    own = written(sequences(conversations), "trie-turns")
    return trie(paths(rebuilt(own)))


# The same in SQL; CRC-32 by its polynomial.
TRIE_SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS entries),
ids AS (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL),
heads AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base,
         xor(list_reduce([4294967295] || list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                         lambda a, b: xor(a >> 8, entries[(xor(a, b) & 255) + 1])), 4294967295) % 6 AS h
  FROM ids, crc_table),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL),
taken AS (
  SELECT c.conv_id, i, role, text FROM heads c JOIN turns t ON t.conv_id = c.base AND t.i <= c.h
  UNION ALL
  SELECT c.conv_id, 1000 + i, role, text FROM heads c JOIN turns t ON t.conv_id = c.conv_id AND t.i > c.h),
paths AS (
  SELECT c.conv_id, coalesce(list(md5(length(role) || ':' || role || text) ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS path,
         coalesce(list(length(text) ORDER BY i) FILTER (WHERE i IS NOT NULL), []) AS sizes
  FROM heads c LEFT JOIN taken t ON t.conv_id = c.conv_id GROUP BY c.conv_id),
prefixes AS (SELECT conv_id, path, unnest(range(len(path) + 1)) AS d, sizes FROM paths),
nodes AS (
  SELECT list_slice(path, 1, d) AS node, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(if(d = 0, 0, sizes[d])) AS size,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE len(path) = d), '')) AS ends
  FROM prefixes GROUP BY 1, 2),
children AS (SELECT list_slice(node, 1, d - 1) AS node, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
sized AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON n.node = c.node AND n.d = c.d),
above AS (SELECT unnest(list_transform(range(d + 1), lambda k: list_slice(node, 1, k))) AS node, (n_convs - 1) * size AS saved, n_children = 0 AS leaf FROM sized),
sums AS (SELECT node, sum(saved) AS saved, count_if(leaf) AS leaves FROM above GROUP BY node)
SELECT s.conv_id, CAST(s.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, CAST(s.n_convs AS BIGINT) AS n_convs,
       CAST(s.n_children AS BIGINT) AS n_children, CAST(u.leaves AS BIGINT) AS n_leaves, CAST(u.saved AS BIGINT) AS saved_tokens, s.ends AS ends_sha256
FROM sized s JOIN sums u ON s.node = u.node LEFT JOIN nodes p ON s.d > 0 AND p.d = s.d - 1 AND p.node = list_slice(s.node, 1, s.d - 1)
"""
