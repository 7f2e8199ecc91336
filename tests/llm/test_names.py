"""Columns of other tables, or of the operators themselves, among those of the documents."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from odflow.llm import (
    jaccard_join,
    mixing,
    names,
    near_dedup,
    neighbours,
    packing,
    quality_classifier,
    quality_rules,
    queries,
    substring_dedup,
    token_counts,
    toxicity,
    transducer,
)

CLASHING = (
    "toxic quality share _gone _twice _cut_id _cuts _mix_id _mix_source _mix_size _mix_copies "
    "_mix_words _mix_copy band id _id _label_id n size key weight doc copy component_id kept"
).split()


@pytest.fixture(scope="module")
def wide(docs):
    """The documents with a column of every name that the operators use."""
    extra = [F.concat(F.lit(f"{c} "), F.coalesce("doc_id", F.lit(-1))).alias(c) for c in CLASHING]
    return docs.drop(*CLASHING).select("*", *extra)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, i % 3 == 0) for i in range(13)]
    return spark.createDataFrame(rows, "doc_id BIGINT, quality INT, t BOOLEAN").select(
        "doc_id", "quality", F.col("t").cast("int").alias("toxic")
    )


def bag(df):
    return Counter(tuple(r) for r in df.collect())


def test_fresh_names(wide):
    found = names.fresh(wide, "_GONE", "new", "NEW")
    assert found[1:] == ["new", "_NEW"] and found[0].lower() not in {c.lower() for c in wide.columns}


def test_operators_do_not_look_at_other_columns(docs, wide, labels):
    def results(table):
        yield token_counts.token_counts(table, queries.vocabulary())
        yield toxicity.toxicity(table, toxicity.fit(table, labels))
        yield near_dedup.near_duplicates(table)
        yield packing.pack(table, queries.vocabulary())
        yield substring_dedup.repeated_passages(table)
        yield quality_rules.quality_rules(table)
        yield quality_classifier.quality(table, quality_classifier.fit(table, labels))
        yield mixing.mix(table)
        yield jaccard_join.jaccard_components(table)

    # Sequence numbers are any numbers.
    for a, b in zip(results(docs), results(wide), strict=True):
        assert a.columns == b.columns
        shown = [c for c in a.columns if c not in ("sequence_id", "offset")]
        assert bag(a.select(shown)) == bag(b.select(shown))


def test_stages_keep_clashing_columns(docs, wide, labels):
    stages = (
        lambda t: quality_classifier.keep_good(t, labels),
        near_dedup.drop_near_duplicates,
        substring_dedup.drop_repeats,
        mixing.take_mix,
    )
    for stage in stages:
        kept = stage(wide)
        assert kept.columns == wide.columns
        assert bag(kept.select("doc_id", "text")) == bag(stage(docs).select("doc_id", "text"))
        for row in kept.collect():
            i = -1 if row["doc_id"] is None else row["doc_id"]
            assert all(row[c] == f"{c} {i}" for c in CLASHING)


def test_a_repeated_label_is_one_row(spark, docs, labels):
    many = docs.filter("doc_id = 2").withColumn("text", F.explode(F.array(*map(F.lit, "zyx"))))
    table = docs.filter("doc_id <> 2").unionByName(many)
    rows = toxicity.training_rows(table, labels, 100, "doc_id", "text").filter("_label_id = 2").collect()
    assert len(rows) <= 1
    good = quality_classifier.labelled_rows(table, labels, 100, "doc_id", "text").collect()
    assert [r["text"] for r in good if r["text"] in ("x", "y", "z")] == ["x"]


def test_percent_has_a_range(docs):
    for percent in (40, 101):
        with pytest.raises(ValueError):
            near_dedup.near_duplicates(docs, percent=percent)


def test_cosines_of_extreme_vectors(spark):
    rows = [(0, [1e200, 1e200]), (1, [1e200, 0.0]), (2, [1e-200, 1e-200]), (3, [-5e-324, 0.0])]
    table = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    found = neighbours.nearest(table, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [2, 1, 3]
    assert np.allclose([r["score"] for r in found], [1.0, 0.5**0.5, -(0.5**0.5)], rtol=0, atol=1e-15)


def test_cut_at_many_special_strings():
    machine = transducer.tokenizer(queries.vocabulary())
    special = next(iter(machine.special))
    text = f"a{special}{special} b ".encode() * 100_000 + b"end"
    parts = machine._cut(text)
    assert len(parts) == 200_001 and parts[-1] == (b" b end", -1)
    assert parts[:3] == [(b"a", machine.special[special]), (b"", machine.special[special]), (b" b a", machine.special[special])]
