"""Filter interaction audit: what each filter removes, in every order in which the filters could run.

A document fails some of the filters. As a mask row with 0 for a filter that it fails and infinity
for the others, its min-plus product with the positions of the filters in all orders (the inverse
permutations) is the step that removes it in each order. Documents of one part that fail the same
filters share that row, so the matrices have a row per part and mask however large the corpus is; the
counts of documents are scattered to (order, step) by weight.

Rows: a null text is empty, a null lang the part ''. Labels of several rows of a doc_id add up
(quality or toxic is 1 in one of them). A row without doc_id has no labels, no smaller doc_id and
is no earlier copy of another row. Rows of one doc_id and text are copies of smaller ones only.
Equal texts are those of equal SHA-256. An empty table has no parts and no rows. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
# White space between words, characters that filter D looks for, least words, shares in per cent.
WORD = r"[^\x20\x09-\x0D]+"
MARKS = r"[#$%&*|]"
LEAST_WORDS, DISTINCT, CAPITALS = 200, 50, 3
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
SCHEMA = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)


def own_failures(docs: DataFrame) -> DataFrame:
    """(doc_id, part, digest, mask): the filters that a text fails by itself, a bit each in the order of FILTERS."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    read = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        text.alias("text"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
    )
    n = F.size("words")
    fails = (
        n < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")) < DISTINCT * n,
        100 * F.regexp_count("text", F.lit("[A-Z]")).cast("long") > CAPITALS * F.length("text").cast("long"),
        F.col("text").rlike(MARKS),
    )
    return read.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), sum_bits(fails).alias("mask"))


def sum_bits(fails: tuple[Column, ...]) -> Column:
    mask = F.lit(0)
    for bit, failed in enumerate(fails):
        mask = mask.bitwiseOR(F.when(failed, 1 << bit).otherwise(0))
    return mask


def mask_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): documents by the filters that they fail and their labels.

    Rows travel without their texts. Copies are counted by aggregates that start before their
    shuffle: of each digest, part, mask and label only the smallest doc_id is needed, its rows and all rows.
    """
    marked = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.expr("coalesce(quality = 1, false)")).alias("good"), F.max(F.expr("coalesce(toxic = 1, false)")).alias("toxic")
    )
    kind = ["digest", "part", "mask", "good", "toxic"]
    known = (
        own_failures(docs.where("doc_id is not null"))
        .join(marked, "doc_id", "left")
        .na.fill(False, ["good", "toxic"])
        .groupBy("doc_id", *kind)
        .agg(F.count("*").alias("n"))
    )
    nameless = (
        own_failures(docs.where("doc_id is null"))
        .select("doc_id", "digest", "part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
        .groupBy("doc_id", *kind)
        .agg(F.count("*").alias("n"))
    )
    copies = (
        known.unionByName(nameless)
        .groupBy(*kind)
        .agg(
            F.min("doc_id").alias("first"),
            F.min_by("n", "doc_id").alias("n_first"),
            F.sum(F.expr("if(doc_id is null, n, 0)")).alias("n_nameless"),
            F.sum("n").alias("n"),
        )
    )
    seen = copies.withColumn("smallest", F.min("first").over(Window.partitionBy("digest")))
    original = F.expr("n_nameless + if(first = smallest, n_first, 0L)")
    last = 1 << FILTERS.index("E")
    split = F.explode(
        F.array(
            F.struct(F.col("mask").alias("mask"), original.alias("n")),
            F.struct(F.col("mask").bitwiseOR(last).alias("mask"), (F.col("n") - original).alias("n")),
        )
    )
    return (
        seen.select("part", "good", "toxic", split.alias("some"))
        .where("some.n > 0")
        .groupBy("part", "some.mask", "good", "toxic")
        .agg(F.sum("some.n").alias("n"))
    )


def removal_steps(masks: np.ndarray) -> np.ndarray:
    """Min-plus product of mask rows and positions: the step, from 1, that removes a mask in each order; STEPS + 1 if none does."""
    rows = np.where(masks[:, None] >> np.arange(STEPS) & 1, 0.0, np.inf)
    order = np.array([[FILTERS.index(f) for f in o] for o in ORDERS])
    positions = np.argsort(order, axis=1).T + 1.0
    steps = (rows[:, :, None] + positions[None]).min(axis=1)
    return np.where(np.isinf(steps), STEPS + 1, steps).astype(np.int64)


def scattered(steps: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Weights added up by order and step."""
    out = np.zeros((len(ORDERS), STEPS + 2), np.int64)
    np.add.at(out, (np.broadcast_to(np.arange(len(ORDERS)), steps.shape), steps), weights[:, None])
    return out[:, 1:]


def audit_part(counts: pd.DataFrame) -> pd.DataFrame:
    """All orders and steps of one part, from its at most 2 ** 7 rows of mask_counts."""
    masks, n = counts["mask"].to_numpy(np.int64), counts["n"].to_numpy(np.int64)
    steps = removal_steps(masks)
    by_step = scattered(steps, n)
    removed = by_step[:, :STEPS]
    good = scattered(steps, n * counts["good"].to_numpy(bool))[:, :STEPS]
    toxic = scattered(steps, n * counts["toxic"].to_numpy(bool))[:, :STEPS]
    letters = np.array([[FILTERS.index(f) for f in o] for o in ORDERS])
    fails = masks[:, None] >> np.arange(STEPS) & 1
    # Of the documents that fail the filter of a step, those that an earlier step removed.
    gone = steps[:, :, None] < np.arange(1, STEPS + 1)
    redundant = (n[:, None, None] * fails[:, letters] * gone).sum(axis=0)
    only = np.array([n[masks == 1 << f].sum() for f in range(STEPS)])
    credit = np.bincount(letters.ravel(), removed.ravel(), STEPS).astype(np.int64)
    return pd.DataFrame(
        {
            "part": counts["part"].iloc[0],
            "filter_order": np.repeat(ORDERS, STEPS),
            "step": np.tile(np.arange(1, STEPS + 1, dtype=np.int32), len(ORDERS)),
            "kept": (n.sum() - np.cumsum(removed, axis=1)).ravel(),
            "removed": removed.ravel(),
            "redundant": redundant.ravel(),
            "unique_fails": only[letters].ravel(),
            "good_lost": good.ravel(),
            "toxic_lost": toxic.ravel(),
            "shapley": credit[letters].ravel(),
        }
    )


def audited(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every order and step, for each part of the documents."""
    return mask_counts(docs, labels).groupBy("part").applyInPandas(audit_part, SCHEMA)


# The same in SQL.
AUDIT_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
first_ids AS (SELECT body, min(doc_id) AS first_id FROM docs GROUP BY body),
marks AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         map {'A': len(words) < 200,
              'B': 100 * len(list_distinct(words)) < 50 * len(words),
              'C': 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 3 * length(body),
              'D': regexp_matches(body, '[#$%&*|]'),
              'E': coalesce(d.doc_id > first_id, false)} AS fails
  FROM docs d JOIN first_ids USING (body) LEFT JOIN marks m ON d.doc_id = m.doc_id),
counts AS (SELECT part, good, toxic, fails, count(*) AS n FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT [a.x, b.x, c.x, d.x, e.x] AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
ranked AS (
  SELECT part, good, toxic, fails, n, o,
         coalesce(list_min([i FOR x, i IN o IF fails[x]]), 6) AS rank
  FROM counts, orders),
steps AS (SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders),
summed AS (
  SELECT part, array_to_string(r.o, '') AS filter_order, step, r.o[step] AS letter,
         sum(if(rank > step, n, 0)) AS kept, sum(if(rank = step, n, 0)) AS removed,
         sum(if(fails[r.o[step]] AND rank < step, n, 0)) AS redundant,
         sum(if(fails[r.o[step]] AND len([x FOR x IN r.o IF fails[x]]) = 1, n, 0)) AS unique_fails,
         sum(if(rank = step AND good, n, 0)) AS good_lost, sum(if(rank = step AND toxic, n, 0)) AS toxic_lost
  FROM ranked r JOIN steps s ON r.o = s.o GROUP BY part, r.o, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM summed
"""
