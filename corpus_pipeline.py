"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from odflow.llm import mixing, near_dedup, packing, quality_classifier, substring_dedup
from odflow.llm.queries import vocabulary
from odflow.sources.scratch import materialize


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.keep_good(docs, labels)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words, similarity 0.8."""
    return near_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has."""
    cut = substring_dedup.drop_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out so that sources meet their target weights."""
    return mixing.take_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in sequences of 1024 tokens."""
    return packing.pack(docs, vocabulary())


STAGES = [
    ("quality classifier", classify_quality),
    ("near dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

# No stage's rows follow from SQL: the tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
