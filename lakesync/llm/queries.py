"""One query for each operator, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakesync.llm import (
    decontaminate,
    filter_audit,
    html_text,
    jaccard,
    language,
    mixing,
    passages,
    prefix_trie,
    pseudonyms,
    quality_rules,
    secrets,
    simhash,
    toxicity,
)
from lakesync.llm.common import table


def op1_extract_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extracted(table(spark, sf_dir, "pages"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.document_shares(table(spark, sf_dir, "documents"))


def op3_pseudonymise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a parameter of the operator; a job gives its own."""
    return pseudonyms.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"), b"key of this query")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.document_components(table(spark, sf_dir, "documents"))


def op7_find_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.document_secrets(table(spark, sf_dir, "documents"))


def op8_score_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.document_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.repeated(table(spark, sf_dir, "documents"))


def op10_identify_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.document_languages(table(spark, sf_dir, "documents"))


def op11_audit_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


def op13_simhash_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.document_components(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_extract_text,
        op2_mix_sources,
        op3_pseudonymise,
        op4_decontaminate,
        op5_quality_rules,
        op6_jaccard_join,
        op7_find_secrets,
        op8_score_toxicity,
        op9_repeated_passages,
        op10_identify_language,
        op11_audit_filters,
        op12_prefix_trie,
        op13_simhash_join,
    )
}
ORACLE: dict[str, str] = {"op11_audit_filters": filter_audit.AUDIT_SQL, "op12_prefix_trie": prefix_trie.TRIE_SQL}
