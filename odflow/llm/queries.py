"""The registered queries of this package and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.llm import (
    conversation_repair,
    html_extract,
    jaccard_join,
    mixing,
    near_dedup,
    neighbours,
    packing,
    prefix_trie,
    quality_classifier,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
)
from odflow.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES", "vocabulary"]

TOKENIZER = "byte_bpe_50k.json"


def vocabulary(name: str = TOKENIZER) -> str:
    """Path of a public vocabulary file; ``ODFLOW_TOKENIZERS`` names another folder."""
    folder = os.environ.get("ODFLOW_TOKENIZERS")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), vocabulary())


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle=2)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality_rules.quality_rules(_table(spark, sf_dir, "documents"))
    return rated.select("doc_id", *quality_rules.MEASURES, "base_failed", "kept")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality_classifier.fit(docs, _table(spark, sf_dir, "labels"))
    return quality_classifier.quality(docs, model)


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair_conversations(_table(spark, sf_dir, "conversations"))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(_table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_token_counts": op1_token_counts,
    "op2_toxicity": op2_toxicity,
    "op3_near_dedup": op3_near_dedup,
    "op4_packing": op4_packing,
    "op5_substring_dedup": op5_substring_dedup,
    "op6_nearest_neighbours": op6_nearest_neighbours,
    "op7_html_extraction": op7_html_extraction,
    "op8_quality_rules": op8_quality_rules,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_source_mixing": op10_source_mixing,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_jaccard_join": op12_jaccard_join,
    "op13_prefix_trie": op13_prefix_trie,
}
