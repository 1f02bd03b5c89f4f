"""N-gram Jaccard join by a token-group matrix.

Sets are the distinct word shingles of a text as 64-bit hashes. Texts with equal sets are one
class, and a class has one representative. Representatives are partitioned into groups of
similar ones: each meets the most central member of its minhash buckets, and what is verified
to link with it is in its group; where a crowd does not link with it, all its tokens elect another
centre, which these meet. The matrix has, for each token and group, the range of sizes
of the group's members with that token. A representative looks up the tokens of its prefix
(rarest first, long enough that a linked pair must share one) and gets the groups that may
hold a link; the overlap with the union of a group's tokens bounds the overlap with any of
its members, and only groups within the bound are opened and compared member by member; one
link into a group is kept, as its members are connected.

Two sets link when 100 * intersection >= 75 * union, that is 7 * intersection >= 3 * (sum of sizes).
Links inside a group that is connected anyway are not looked for, so a group of copies costs
one comparison each; no link between groups is missed.

Rows: an empty or null text has an empty set and links with nothing. Rows of the same doc_id
are one node, so they share a component; a null doc_id links with nothing and its component is
null. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakesync.llm.common import SPREAD, components, dealt, discard, distinct_sets, mixed, shingles, stream, text_slices, words, written

SIZE = 5
MINS = 8
# Equal minima with the central member at which a representative is compared with it.
ALIKE = 3
# A prefix has one token more for so many tokens of its set, and a pair must share as many more: chance matches do not.
FURTHER = 32
# Representatives that do not link with their central one, above which another centre is taken by all their tokens.
CROWD = 16
# Most members of a group; a larger cluster is several groups.
MEMBERS = 64
# Tokens that come last in a prefix because many texts have them: a matter of speed, not of results.
COMMON = 1 << 17
PENDING = 1 << 21
SLOT_BITS = np.uint64(44)


def token_sets(column: pa.Array, size: int):
    """(first row, end row, tokens, offsets) of slices: each row's distinct tokens, ascending."""
    for low, high, data, offsets in text_slices(column):
        hashes, rows, _, _ = words(data, offsets)
        tokens, rows, _ = shingles(hashes, rows, size)
        yield low, high, *distinct_sets(tokens, rows, high - low)


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    summed = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values, out=summed[1:])
    return summed[offsets[1:]] - summed[offsets[:-1]]


def signatures(docs: DataFrame, size: int) -> DataFrame:
    """Per text: doc_id, n, the fingerprint (f1, f2) of its set, its minima; and apart, tokens that a task met repeatedly."""

    def common(pending: list, kept: list) -> None:
        tokens, times = np.unique(np.concatenate(pending), return_counts=True)
        kept.append((tokens[times > 1], times[times > 1]))
        pending.clear()

    def run(batches):
        pending, kept, waiting = [], [], 0
        for batch in batches:
            column = batch.column("text")
            n, f1, f2 = (np.zeros(len(column), np.int64) for _ in range(3))
            minima = np.zeros((len(column), MINS), np.int64)
            for low, high, tokens, offsets in token_sets(column, size):
                n[low:high] = np.diff(offsets)
                f1[low:high] = row_sums(mixed(tokens * SPREAD[8]), offsets).view(np.int64)
                f2[low:high] = row_sums(mixed(tokens * SPREAD[9]), offsets).view(np.int64)
                some = np.flatnonzero(n[low:high])
                if len(some):
                    for j in range(MINS):
                        minima[low + some, j] = np.minimum.reduceat(mixed(tokens * SPREAD[10 + j]), offsets[some]).view(np.int64)
                pending.append(tokens)
                waiting += len(tokens)
                if waiting > PENDING:
                    common(pending, kept)
                    waiting = 0
            flat = pa.array(minima.ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(column) + 1, dtype=np.int32) * MINS), flat)
            none = pa.nulls(len(column), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n), pa.array(f1), pa.array(f2), lists, none, none], names=names
            )
        if pending:
            common(pending, kept)
        for tokens, times in kept:
            none = [pa.nulls(len(tokens), x) for x in (doc_type, pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array(tokens.view(np.int64)), pa.array(times)], names=names)

    names = ["doc_id", "n", "f1", "f2", "minima", "token", "times"]
    doc_type = pa.int64()
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, f1 long, f2 long, minima array<long>, token long, times long"
    )


def sets_of(docs: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """(doc_id, tokens) of the documents in `wanted` (doc_id)."""

    def run(batches):
        for batch in batches:
            for low, high, tokens, offsets in token_sets(batch.column("text"), size):
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(tokens.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), lists], names=["doc_id", "tokens"])

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted.hint("shuffle_hash"), "doc_id", "left_semi")
    return some.mapInArrow(run, "doc_id long, tokens array<long>")


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those that link."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("tokens").alias("of_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("tokens").alias("of_b"))
    both = F.size(F.array_intersect("of_a", "of_b"))
    return pairs.join(left, "a").join(right, "b").where(7 * both >= 3 * (F.size("of_a") + F.size("of_b"))).select("a", "b").distinct()


def sizes_allow(a: str, b: str):
    """Only sets of at least 3/4 of the other's size can link."""
    return (4 * F.col(a) >= 3 * F.col(b)) & (4 * F.col(b) >= 3 * F.col(a))


def central_pairs(classes: DataFrame) -> DataFrame:
    """(a, b): each representative and the most central member, by size of its buckets, of the minhash buckets it is in."""
    places = classes.select("rep", F.posexplode("minima").alias("j", "value"))
    # Counts and centres are stored, so that hot buckets meet them in joins whose partitions can be split.
    buckets = written(places.groupBy("j", "value").agg(F.count("*").alias("bucket")).where("bucket > 1"), "jaccard-bucket-counts")
    crowded = written(places.join(buckets, ["j", "value"]), "jaccard-buckets")
    weight = crowded.groupBy("rep").agg(F.sum("bucket").alias("weight"))
    centres = crowded.join(weight, "rep").groupBy("j", "value").agg(F.max(F.struct("weight", -F.col("rep"))).alias("top"))
    centres = written(centres, "jaccard-centres")
    pairs = (
        crowded.join(centres, ["j", "value"])
        .select(F.col("rep").alias("a"), (-F.col("top.col2")).alias("b"))
        .where("a != b")
        .groupBy("a", "b")
        .agg(F.count("*").alias("alike"))
        .where(F.col("alike") >= ALIKE)
    )
    of = classes.select("rep", "n")
    return (
        pairs.join(of.toDF("a", "na"), "a").join(of.toDF("b", "nb"), "b").where(sizes_allow("na", "nb")).select("a", "b")
    )


def recentred(near: DataFrame, stars: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b): representatives that do not link with their central one, where there is a crowd of them, and a better centre.

    The centre is the one that differs in the fewest tokens from all that met the old centre, by the number of
    these that have each token. The old centre meets it too, so what links with either is one cluster.
    """
    failed = near.join(stars, ["a", "b"], "left_anti")
    crowds = failed.groupBy("b").agg(F.count("*").alias("failed")).where(F.col("failed") > CROWD).select("b")
    near = near.join(crowds, "b")
    met = written(near.union(near.select("b", F.col("b").alias("a")).distinct()), "jaccard-crowds")
    # A centre with very many has its tokens counted before their shuffle, and the counts meet them in a join that can be split.
    tokens = written(met.join(sets, F.col("a") == F.col("doc_id")).select("b", "a", F.explode("tokens").alias("token")), "jaccard-crowd-tokens")
    votes = written(tokens.groupBy("b", "token").agg(F.count("*").alias("votes")).where("votes > 1"), "jaccard-votes")
    total = met.groupBy("b").agg(F.count("*").alias("total"))
    score = tokens.join(votes, ["b", "token"]).groupBy("b", "a").agg(F.sum("votes").alias("votes")).join(total, "b")
    sized = score.join(sets.select(F.col("doc_id").alias("a"), F.size("tokens").alias("n")), "a")
    best = sized.groupBy("b").agg(F.max(F.struct(F.expr("2 * votes - total * n").alias("near"), -F.col("a"))).alias("top"))
    asking = failed.join(crowds, "b").union(crowds.select(F.col("b").alias("a"), "b"))
    return asking.join(best, "b").select("a", (-F.col("top.col2")).alias("b")).where("a != b").distinct()


def prefixes(docs: DataFrame, groups: DataFrame, common: DataFrame, size: int) -> DataFrame:
    """(token, doc, cluster, packed, reach) of every representative's prefix, rarest tokens first.

    packed holds n and the group's number in its cluster, 31 bits each, and whether the token is in the shorter
    prefix, the one that suffices towards texts of the same size or larger. reach is the largest set towards
    which the prefix goes as far as the token: with a larger one, too few tokens are left for a link.
    """
    listed = common.toArrow()
    order = np.argsort(listed.column("token").to_numpy())
    known = listed.column("token").to_numpy()[order].view(np.uint64)
    rank = (1 + np.log2(np.maximum(listed.column("times").to_numpy()[order], 1))).astype(np.int64)
    sort = np.argsort(known)
    shared = docs.sparkSession.sparkContext.broadcast((known[sort], rank[sort]))

    def run(batches):
        known, rank = shared.value
        taken = np.zeros(1 << (64 - int(SLOT_BITS)), bool)
        taken[known >> SLOT_BITS] = True
        for batch in batches:
            doc, cluster, part = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "cluster", "part"))
            for low, high, tokens, offsets in token_sets(batch.column("text"), size):
                n = np.diff(offsets)
                row = np.repeat(np.arange(high - low), n)
                maybe = np.flatnonzero(taken[tokens >> SLOT_BITS])
                if len(maybe):
                    at = np.minimum(np.searchsorted(known, tokens[maybe]), len(known) - 1)
                    late = np.zeros(len(tokens), np.int64)
                    late[maybe] = np.where(known[at] == tokens[maybe], rank[at], 0)
                    tokens = tokens[np.argsort(row * 128 + late, kind="stable")]
                place = np.arange(len(tokens)) - np.repeat(offsets[:-1], n)
                longer, shorter = (n - -(-least // of) + 1 + n // FURTHER for least, of in ((3 * n, 4), (6 * n, 7)))
                keep = place < longer[row]
                row, place, tokens = row[keep], place[keep], tokens[keep]
                packed = (n[row] << 32) | (part[low + row] << 1) | (place < shorter[row])
                # 7 * (tokens left + those that may be shared before) >= 3 * (sum of sizes)
                reach = 7 * (n[row] - place + n[row] // FURTHER) // 3 - n[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(doc[low + row]), pa.array(cluster[low + row]), pa.array(packed), pa.array(reach.astype(np.int32))],
                    names=["token", "doc", "cluster", "packed", "reach"],
                )

    some = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(groups.hint("shuffle_hash"), "doc_id")
    return some.select("doc_id", "cluster", "part", "text").mapInArrow(run, "token long, doc long, cluster long, packed long, reach int")


def candidates(rows: DataFrame) -> DataFrame:
    """(cluster, part, other, other_part): groups of different clusters that share enough prefix tokens and may link by size.

    The smaller of a linked pair, of m tokens, shares at least 1 + m // FURTHER tokens of its
    shorter prefix with the longer prefix of the larger. Both sides look up by group, so a token
    of a large cluster counts once for each of its groups and not for each of its members. Texts
    that have much of a frequent passage, but too little for a link, do not meet by its tokens: for
    the sizes of a pair, these lie behind its prefixes.
    """
    first = F.col("packed").bitwiseAND(F.lit(1)) == 1
    n = F.shiftright("packed", 32)
    # One exchange by token serves both sides.
    matrix = (
        dealt(rows, "token")
        .groupBy("token", "cluster", F.shiftright("packed", 1).bitwiseAND(F.lit((1 << 31) - 1)).alias("part"))
        .agg(
            F.min(n).alias("low"),
            F.max(n).alias("high"),
            F.min(F.when(first, n)).alias("least"),
            F.max(F.when(first, n)).alias("most"),
            F.max("reach").alias("wide"),
            F.max(F.when(first, F.col("reach"))).alias("far"),
        )
    )
    smaller = matrix.select("token", F.col("cluster").alias("other"), F.col("part").alias("other_part"), "least", "most", "far")
    return (
        matrix.select("token", "cluster", "part", "low", "high", "wide")
        .join(smaller, "token")
        .where("cluster != other and least <= high and 4 * most >= 3 * low and low <= far and least <= wide")
        .groupBy("cluster", "part", "other", "other_part")
        .agg(F.count("*").alias("shared"), F.min("least").alias("least"))
        .where(F.col("shared") > F.expr(f"least div {FURTHER}"))
        .drop("shared", "least")
    )


def links(docs: DataFrame, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """(documents with doc_id, n, f1, f2, rep) and (edges a, b between representatives), whose components are those of all links."""
    signed = written(signatures(docs, size), "jaccard-signatures")
    documents = signed.where("token is null").select("doc_id", "n", "f1", "f2", "minima")
    common = signed.where("token is not null").groupBy("token").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "token").limit(COMMON)
    classes = written(
        documents.where("n > 0 and doc_id is not null")
        .groupBy("n", "f1", "f2")
        .agg(F.min("doc_id").alias("rep"), F.first("minima").alias("minima")),
        "jaccard-classes",
    )
    near = written(central_pairs(classes), "jaccard-central")
    near_sets = written(sets_of(docs, near.select(F.col("a").alias("doc_id")).union(near.select("b")).distinct(), size), "jaccard-sets")
    stars = written(verified(near, near_sets), "jaccard-stars")
    further = written(recentred(near, stars, near_sets), "jaccard-recentred")
    stars = stars.union(written(verified(further, near_sets), "jaccard-stars"))
    discard(near_sets)
    clusters = components(stars, "jaccard-clusters")
    groups = written(grouped(classes, clusters), "jaccard-groups")
    rows = written(prefixes(docs, groups, common, size), "jaccard-prefixes")
    pairs = written(candidates(rows), "jaccard-candidates")
    discard(rows)
    # Each member of the one group asks the other group.
    asking = groups.select("cluster", "part", F.col("doc_id").alias("doc"), "n")
    maybe = written(
        pairs.join(asking, ["cluster", "part"]).select("doc", "n", F.col("other").alias("cluster"), F.col("other_part").alias("part")),
        "jaccard-asked",
    )
    # Groups that may hold a link, and all their members.
    members = groups.select("cluster", "part", F.col("doc_id").alias("member"), F.col("n").alias("size"), "alone")
    hit = maybe.select("cluster", "part").distinct().join(members, ["cluster", "part"])
    wanted = hit.select(F.col("member").alias("doc_id")).union(maybe.select("doc")).distinct()
    sets = written(sets_of(docs, wanted, size), "jaccard-sets")
    # Members in one row: a pair of them is not a row, and as they are connected, one link is enough.
    opened = (
        hit.where("not alone")
        .join(sets, F.col("member") == F.col("doc_id"))
        .groupBy("cluster", "part")
        .agg(F.collect_list(F.struct("member", "size", F.col("tokens").alias("held"))).alias("members"), F.min("size").alias("least"))
        .withColumn("union", F.array_distinct(F.flatten("members.held")))
    )
    linked = F.filter(
        "members",
        lambda m: F.when(
            (4 * F.col("n") >= 3 * m["size"]) & (4 * m["size"] >= 3 * F.col("n")),
            7 * F.size(F.array_intersect("tokens", m["held"])) >= 3 * (F.col("n") + m["size"]),
        ).otherwise(False),
    )
    among = (
        maybe.join(opened, ["cluster", "part"])
        .join(sets, F.col("doc") == F.col("doc_id"))
        .where(7 * F.size(F.array_intersect("tokens", "union")) >= 3 * (F.col("n") + F.col("least")))
        .select(F.col("doc").alias("a"), F.try_element_at(F.transform(linked, lambda m: m["member"]), F.lit(1)).alias("b"))
        .where("b is not null")
    )
    single = maybe.join(members.where("alone"), ["cluster", "part"]).where(sizes_allow("n", "size"))
    pairs = single.select(F.least("doc", "member").alias("a"), F.greatest("doc", "member").alias("b")).distinct()
    more = written(verified(written(pairs, "jaccard-pairs"), sets).union(written(among, "jaccard-opened")), "jaccard-links")
    discard(sets)
    return documents.join(classes.drop("minima"), ["n", "f1", "f2"], "left"), stars.union(more)


def grouped(classes: DataFrame, clusters: DataFrame) -> DataFrame:
    """(doc_id, n, cluster, part, alone) of representatives: a large cluster is cut into groups by a hash."""
    rows = classes.select(F.col("rep").alias("doc_id"), "n").join(clusters.toDF("doc_id", "root"), "doc_id", "left")
    rows = rows.withColumn("cluster", F.coalesce("root", "doc_id"))
    counts = clusters.groupBy(F.col("root").alias("cluster")).agg(F.count("*").alias("count"))
    parts = F.ceil(F.coalesce("count", F.lit(1)) / MEMBERS)
    return rows.join(counts, "cluster", "left").select(
        "doc_id", "n", "cluster", F.pmod(F.xxhash64("doc_id"), parts).alias("part"), F.col("root").isNull().alias("alone")
    )


def document_components(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id that links lead to, of every document."""
    documents, edges = links(docs, size)
    copies = documents.where("rep is not null").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    # Rows of one doc_id are one node; where each has a set of its own, it stands in several classes.
    twice = copies.distinct().groupBy("a").agg(F.count("*").alias("sets"), F.min("b").alias("least")).where("sets > 1")
    bridged = copies.join(twice, "a").where("b != least").select(F.col("b").alias("a"), F.col("least").alias("b"))
    roots = components(edges.union(bridged.distinct()), "jaccard-components").toDF("rep", "root")
    joined = documents.join(roots, "rep", "left").withColumn("component_id", F.coalesce("root", "rep", "doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame, size: int = SIZE) -> DataFrame:
    """docs with one row of each component: the one with the smallest doc_id, null last, of equal ones that of the smallest hash.

    Every row is a node of its own, so rows of one doc_id, or without one, that do not link by their shingles all stay.
    """
    # Numbers of rows must not change between steps. The rows travel as one struct, so that no name of theirs can clash.
    stored = written(docs.select(F.monotonically_increasing_id().alias("key"), F.struct(*docs.columns).alias("row")), "jaccard-rows")
    documents, edges = links(stored.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")), size)
    roots = components(edges, "jaccard-components").toDF("rep", "root")
    linked = documents.where("rep is not null").join(roots, "rep", "left").select(F.col("doc_id").alias("key"), F.coalesce("root", "rep").alias("component"))
    linked = written(linked, "jaccard-found")
    several = linked.groupBy("component").agg(F.count("*").alias("rows")).where("rows > 1").select("component")
    alike = linked.join(several, "component")
    rank = F.struct(F.col("row.doc_id").isNull(), F.col("row.doc_id"), F.xxhash64("row"), F.col("key"))
    ranked = written(stored.select("key", rank.alias("rank")).join(alike, "key"), "jaccard-ranked")
    first = ranked.groupBy("component").agg(F.min("rank").alias("first"))
    goes = written(ranked.join(first, "component").where("rank.key != first.key").select("key"), "jaccard-goes")
    return stored.join(goes, "key", "left_anti").select("row.*")
