import hashlib
import os
import random
import sys
import zlib
from collections import defaultdict

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from helpers_llm import clashing  # noqa: E402

from lakesync.llm import prefix_trie as P  # noqa: E402

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def told(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute_paths(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, told(role or "", text or ""), role or "", text or ""))
    turns = {c: [t[3:] for t in sorted(some)] for c, some in own.items()}
    out = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        out[c] = tuple(turns.get(base, [])[:h] + mine[h:])
    return out


def brute_trie(paths):
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, some in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(some) - 1) * len(node[-1][1]) if node else 0
    rows = []
    for node, some in members.items():
        ends = ",".join(map(str, sorted(c for c in some if paths[c] == node)))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(some), len(node), parent, len(some), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=repr)


def got(spark, rows, names=()):
    found = P.rebuilt_trie(clashing(spark.createDataFrame(rows, SCHEMA), names))
    assert found.columns == COLUMNS
    return sorted((tuple(r) for r in found.collect()), key=repr)


@pytest.fixture
def shards(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    yield lambda n: spark.conf.set("spark.sql.shuffle.partitions", n)
    spark.conf.set("spark.sql.shuffle.partitions", before)


def made(pick, convs):
    """Conversations that begin alike, copies of each other, and some that are a beginning of another."""
    rows, known = [], []
    for c in convs:
        turns = list(pick.choice(known)[: pick.randint(0, 12)]) if known and pick.random() < 0.7 else []
        turns += [(pick.choice(["user", "bot", None]), pick.choice(["a", "b", "ää", "", None, "long text"])) for _ in range(pick.randint(0, 5))]
        if not turns:
            turns = [("user", "x")]
        known.append(turns)
        rows += [(c, pick.choice([i, i, i, None]), r, t) for i, (r, t) in enumerate(turns)]
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("parts", [1, 7, 23])
def test_brute_force(spark, shards, monkeypatch, parts):
    monkeypatch.setattr(P, "BLOCK", 3)
    monkeypatch.setattr(P, "ROWS", 10)
    shards(parts)
    pick = random.Random(parts)
    rows = made(pick, [*range(0, 260), *range(-130, -90), 10**15, 10**15 + 1])
    assert got(spark, rows) == brute_trie(brute_paths(rows))


def test_hot_beginning_and_many_copies(spark, shards, monkeypatch):
    """Everything begins alike, a third is one conversation; splitters see only the first turns."""
    monkeypatch.setattr(P, "BLOCK", 7)
    shards(11)
    pick = random.Random(9)
    rows = []
    for c in range(300):
        tail = ["same"] if c % 3 == 0 else [pick.choice("pq") for _ in range(pick.randint(1, 9))]
        rows += [(c, i, "user", t) for i, t in enumerate(["hello"] * 6 + tail)]
    want = brute_trie(brute_paths(rows))
    assert got(spark, rows) == want
    monkeypatch.setattr(P, "TURNS_LOOKED", 2)
    assert got(spark, rows) == want


def test_splitters_are_short_and_ascending(spark):
    paths = [bytes([a, b]) * 10 + bytes([c]) * 20 for a in range(3) for b in range(3) for c in range(9)]
    frame = spark.createDataFrame([(p,) for p in paths], "path binary")
    cuts = P.splitters(frame, 20)
    assert cuts == sorted(set(cuts)) and all(any(p.startswith(c) for p in paths) for c in cuts)
    skeleton = P.skeleton_of(cuts)
    assert set(skeleton) == {b""} | {c[:k] for c in cuts for k in range(0, len(c), 20)}


def test_edges(spark):
    assert got(spark, []) == []
    assert got(spark, [(None, 1, "a", "b")]) == []
    lone = [(7, None, None, None), (7, None, None, None), (7, 3, "r", "t"), (None, 1, "x", "y")]
    assert got(spark, lone) == brute_trie(brute_paths(lone))
    # 100 has h = 1 and no base but itself; 105 loses what its base lacks; one conversation may end up without turns.
    turnless = [(c, 0, "user", "only") for c in range(300, 320) if c != 300]
    assert any(not p for p in brute_paths(turnless).values())
    assert got(spark, turnless) == brute_trie(brute_paths(turnless))
    long = [(c, i, "user", f"t{i if i < 150 else i + c}") for c in (1, 2) for i in range(200)] + [(3, 0, "r", "y" * 300_000)]
    names = ["path", "first", "n", "ends", "key", "one", "base", "head", "shard", "skel", "turns"]
    assert got(spark, long, names) == brute_trie(brute_paths(long))


def test_whole_table_and_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    found = P.rebuilt_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    rows = sorted((tuple(r) for r in found.collect()), key=repr)
    want = con.sql(P.TRIE_SQL)
    assert found.columns == want.columns == COLUMNS
    assert rows == sorted(want.fetchall(), key=repr)
    assert rows == brute_trie(brute_paths(con.sql("SELECT conv_id, turn, role, text FROM conversations").fetchall()))
