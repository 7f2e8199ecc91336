"""Tables in the scratch folder and shuffle files: what goes when it is no longer read."""

import os

from pyspark.sql import functions as F

from odflow.llm import near_dedup
from odflow.sources.scratch import discard, materialize, scratch_root, settle


def tables(spark):
    folder = f"{scratch_root(spark)}/odflow"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def written(spark, before):
    return sorted(x.rpartition("-")[0] for x in tables(spark) - before)


def test_tables_on_the_way_are_deleted(spark):
    before = tables(spark)

    def build():
        inner = settle(lambda: materialize(spark.range(5), "inner-part"), "inner")
        part = materialize(spark.range(3), "part")
        both = materialize(inner.union(part), "both")
        discard(part)
        return both.filter("id > 1")

    result = settle(build, "result")
    assert sorted(r["id"] for r in result.collect()) == [2, 2, 3, 4]
    assert written(spark, before) == ["result"]
    discard(result, spark.range(1))
    assert written(spark, before) == []


def test_shuffle_files_go_with_the_query_that_made_them(spark):
    tracker = spark.sparkContext._jsc.sc().env().mapOutputTracker()
    before = tracker.shuffleStatuses().size()
    table = materialize(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert tracker.shuffleStatuses().size() <= before
    assert table.count() == 7
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    assert spark.conf.get(setting, None) is None


def test_dropping_near_copies_leaves_few_tables(docs, spark):
    before = tables(spark)
    rest = near_dedup.drop_near_duplicates(docs, shingle=2)
    assert written(spark, before) == ["near-copies", "near-duplicates", "repeated-ids"]
    assert rest.count() == 10
