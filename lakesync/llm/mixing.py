"""Mixing sources to target weights, by DataFrame functions only.

Every source is one stream of words, its documents in a fixed order, packed into blocks
of `BLOCK` words. Output shards draw how many blocks each source gives them; the draws of
a source number its slots 0, 1, 2, ..., and slot j reads block permutation(j mod blocks),
a keyed permutation of the source's own for each pass. Joining slots and documents on
(source, block) tells what the mix takes.

Rows: a null or blank text has size 0 and gives no words. Repeated rows are separate
documents. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakesync.llm.common import written

# Words of a block.
BLOCK = 64
# Slots of an output shard.
SHARD_SLOTS = 1 << 16
# Cells of the table that finds the source of a draw.
CELLS = 4096
# Documents whose places in a source are summed in one window.
RUN = 2_000
# Slots that a task maps to blocks.
TASK_SLOTS = 200_000
# Rounds of the permutation.
ROUNDS = 10
WORD = r"[^\x20\x09-\x0D]+"


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size): the words of each document."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target, blocks, slots) of each source.

    Weights 1, 2, 3 repeat along the sources by code point, null last. Sources are taken by
    rising size a weight; the longest run of them that the common level would lift above
    three times their size is held there, and the others share what is left by weight.
    The windows here see one row per source.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    rising = Window.orderBy("ratio", "place")
    held = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy("ratio", "place").rowsBetween(0, Window.unboundedFollowing)
    every = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("weight", (F.col("place") - 1) % 3 + 1)
        .withColumn("ratio", (F.col("source_size") * 6 / F.col("weight")).cast("long"))
        .withColumn("left", F.sum("source_size").over(every) - 3 * F.coalesce(F.sum("source_size").over(held), F.lit(0)))
        .withColumn("weights", F.sum("weight").over(rest))
        .withColumn("above", 3 * F.col("source_size") * F.col("weights") < F.col("left") * F.col("weight"))
        .withColumn("at", F.row_number().over(rising))
    )
    free = F.min(F.when(~F.col("above"), F.struct("at", "left", "weights"))).over(every)
    target = F.when(F.col("at") < F.col("free.at"), (3 * F.col("source_size")).cast("double")).otherwise(
        (F.col("free.left") * F.col("weight")).cast("double") / F.col("free.weights")
    )
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    whole = F.when(F.col("source_size") > 0, F.round(F.col("target") * F.col("blocks") / F.col("source_size"))).otherwise(0)
    return (
        ranked.withColumn("free", free)
        .select("source", "source_size", target.alias("target"), blocks.alias("blocks"))
        .withColumn("slots", F.least(whole.cast("long"), 3 * F.col("blocks")))
    )


def slot_count(sources: DataFrame) -> int:
    return sources.agg(F.sum("slots")).first()[0] or 0


def drawn(sources: DataFrame, seed: int) -> DataFrame:
    """(shard, source, blocks, first, count): the slots first .. first + count - 1 of a source go to a shard.

    Each slot of a shard draws its source with the odds of the wanted slots, which makes the
    counts of a shard multinomial. Once a source has all it wants, further draws of it stay
    empty, and one closing shard gives the sources that came short what they miss, so that
    every source ends at its target.
    """
    spark = sources.sparkSession
    total = slot_count(sources)
    width = max(1, -(-total // CELLS))
    cumulated = sources.where("slots > 0").withColumn(
        "below", F.sum("slots").over(Window.orderBy(F.col("source").asc_nulls_last())) - F.col("slots")
    )
    cells = cumulated.select(
        "source",
        "below",
        "slots",
        F.explode(F.sequence(F.expr(f"below div {width}"), F.expr(f"(below + slots - 1) div {width}"))).alias("cell"),
    )
    # At most CELLS rows and one more for each source.
    draws = (
        spark.range(total)
        .select(F.expr(f"id div {SHARD_SLOTS}").alias("shard"), F.pmod(F.xxhash64(F.lit(seed), "id"), F.lit(max(1, total))).alias("draw"))
        .withColumn("cell", F.expr(f"draw div {width}"))
    )
    counts = (
        draws.join(cells, "cell")
        .where("draw >= below and draw < below + slots")
        .groupBy("shard", "source")
        .agg(F.count("*").alias("count"))
    )
    wanted = sources.where("slots > 0").select(F.col("source").alias("of"), "blocks", "slots")
    same = F.col("source").eqNullSafe(F.col("of"))
    earlier = Window.partitionBy("source").orderBy("shard")
    given = (
        counts.withColumn("first", F.sum("count").over(earlier) - F.col("count"))
        .join(wanted, same)
        .withColumn("count", F.least("count", F.greatest(F.lit(0), F.col("slots") - F.col("first"))))
        .select("shard", "source", "blocks", "first", "count")
    )
    drew = counts.groupBy("source").agg(F.sum("count").alias("drew"))
    short = (
        wanted.join(drew, same, "left")
        .select(
            F.lit(-(-total // SHARD_SLOTS)).cast("long").alias("shard"),
            F.col("of").alias("source"),
            "blocks",
            F.least(F.coalesce("drew", F.lit(0)), "slots").alias("first"),
            "slots",
        )
        .withColumn("count", F.col("slots") - F.col("first"))
        .drop("slots")
    )
    return given.unionByName(short).where("count > 0")


def permuted(index: Column, n: Column, *key: Column) -> Column:
    """A keyed permutation of 0 .. n - 1: each round swaps a pair of places or leaves it, as a hash of the pair says."""

    def turn(x: Column, r: Column) -> Column:
        other = F.pmod(F.xxhash64(*key, r) - x, n)
        return F.when(F.xxhash64(F.greatest(x, other), *key, r).bitwiseAND(F.lit(1)) == 1, other).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), index, turn)


def slots(counts: DataFrame, seed: int, total: int) -> DataFrame:
    """(shard, source, slot, block): what every slot of the mix reads, of `total` slots."""
    step = F.lit(4096).cast("long")
    last = F.col("first") + F.col("count") - 1
    slot = F.col("slot")
    return (
        # A hot source's long run of slots is cut before it is dealt out.
        counts.withColumn("from", F.explode(F.sequence(F.col("first"), last, step)))
        .select("shard", "source", "blocks", "from", F.least(F.col("from") + step - 1, last).alias("to"))
        # By number, as the few rows here grow by the step.
        .repartition(1 + total // TASK_SLOTS, "source", "from")
        .withColumn("slot", F.explode(F.sequence("from", "to")))
        .withColumn("pass", F.floor(slot / F.col("blocks")))
        .withColumn("block", permuted(slot % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("source"), F.col("pass")))
        .select("shard", "source", "slot", "block")
    )


def placed(sizes: DataFrame, seed: int) -> DataFrame:
    """Each document with words, with `start`, its first word's place in the stream of its source.

    A source's documents are dealt to runs by a hash, so that a hot source is summed by many
    tasks; the sums of the runs then give each run its own start.
    """
    runs = max(1, sizes.count() // RUN)
    some = sizes.where("size > 0").withColumn("run", F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(runs)))
    inside = Window.partitionBy("source", "run").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        some.groupBy("source", "run")
        .agg(F.sum("size").alias("words"))
        .select(F.col("source").alias("of"), F.col("run").alias("at"), F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    )
    return (
        some.withColumn("inner", F.coalesce(F.sum("size").over(inside), F.lit(0)))
        .join(starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("run") == F.col("at")))
        .withColumn("start", F.col("base") + F.col("inner"))
        .drop("run", "inner", "of", "at", "base")
    )


def blocks_of(documents: DataFrame) -> DataFrame:
    """A row for each block that a placed document has words in, with how many of its words."""
    low = F.col("block") * BLOCK
    return documents.withColumn(
        "block", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + size - 1) div {BLOCK}")))
    ).withColumn("words", F.least(F.col("start") + F.col("size"), low + BLOCK) - F.greatest(F.col("start"), low))


def document_shares(docs: DataFrame, seed: int = 7) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken, source."""
    sizes = written(sized(docs), "mix-sizes")
    sources = written(targets(sizes), "mix-sources")
    pulls = slots(drawn(sources, seed), seed, slot_count(sources)).groupBy("source", "block").agg(F.count("*").alias("pulls"))
    pulls = pulls.select(F.col("source").alias("of"), F.col("block").alias("at"), "pulls")
    taken = (
        blocks_of(placed(sizes, seed))
        # Both sides come from few rows by explode(), so their size is not what statistics say: no broadcast.
        .join(pulls.hint("merge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")), "left")
        .groupBy("doc_id", "source", "size", "start")
        .agg(F.sum(F.col("words") * F.coalesce("pulls", F.lit(0))).alias("taken"))
        .drop("start")
    )
    empty = sizes.where("size = 0").withColumn("taken", F.lit(0).cast("long"))
    shares = sources.select(F.col("source").alias("of"), "source_size", "target")
    # A row for each source; the optimizer broadcasts it where its statistics prove it small.
    return (
        taken.unionByName(empty)
        .join(shares, F.col("source").eqNullSafe(F.col("of")))
        .select("doc_id", "size", "source_size", "target", "taken", "source")
    )


def shard_blocks(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The mix itself: (shard, source, slot, block, text), each slot with the words of its block."""
    rows = docs.select("doc_id", "source", "text").withColumn("w", F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda x: x != ""))
    rows = written(rows.select("doc_id", "source", F.coalesce(F.size("w"), F.lit(0)).cast("long").alias("size"), "w"), "mix-words")
    sources = written(targets(rows), "mix-sources")
    first = F.greatest(F.col("block") * BLOCK - F.col("start"), F.lit(0))
    parts = blocks_of(placed(rows, seed)).select(
        F.col("source").alias("of"), F.col("block").alias("at"), "start", F.slice("w", (first + 1).cast("int"), F.col("words").cast("int")).alias("w")
    )
    # A block holds at most BLOCK words, so its parts are few.
    texts = parts.groupBy("of", "at").agg(F.array_sort(F.collect_list(F.struct("start", "w"))).alias("parts"))
    texts = texts.select("of", "at", F.concat_ws(" ", F.flatten("parts.w")).alias("text"))
    return (
        slots(drawn(sources, seed), seed, slot_count(sources))
        .join(texts.hint("merge"), F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at")))
        .select("shard", "source", "slot", "block", "text")
    )
