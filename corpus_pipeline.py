"""The corpus pipeline: from `documents` to a mix by source.

STAGES are (name, function); a function takes (spark, docs, sf_dir) and returns the documents
that go on, with the columns of `documents`; the last returns what the mix takes of each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakesync.llm import decontaminate, jaccard, language, mixing, secrets
from lakesync.llm.common import table, written

# Least posterior of the predicted language.
SURE = 0.5


def rows(docs: DataFrame) -> DataFrame:
    """Each document as one struct, so that no name in it can clash, and its text."""
    return docs.select(F.struct(*docs.columns).alias("row"), "text")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, and those in none of the learned languages with some certainty, go."""
    known = language.predicted(rows(docs), language.learn(docs))
    return known.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= SURE)).select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by shingles the document with the smallest id stays."""
    return jaccard.one_of_each(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def take_out_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; documents stay."""
    changed = F.col("cleaned") != F.col("row.text")
    new = {"text": F.when(changed, F.col("cleaned")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("cleaned").cast("long")).otherwise(F.col("row.n_chars"))
    return secrets.scanned(rows(docs)).select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.document_shares(docs)


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_benchmark_passages),
    ("secrets", take_out_secrets),
    ("mix", mix_sources),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs


# The language models and the fingerprints have no form in SQL; tests hold the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
