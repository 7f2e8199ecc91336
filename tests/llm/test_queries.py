"""The registered queries run, and the pipeline's stages hand documents on."""

import re
from pathlib import Path

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from odflow.llm.queries import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test tables missing")


def test_registration():
    names = [int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES]
    assert sorted(names) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(queries())
    assert set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_returns_rows(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in Path(SF).glob("*.parquet"):
        db.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    expected = db.execute(ORACLE[name])
    columns = [d[0] for d in expected.description]
    rows = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, rows)) == sorted(expected.fetchall())


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        if i < 4:
            assert docs.columns == columns, name
        if i < 3:
            assert 0 < docs.count() <= n, name
            n = docs.count()
    assert {"sequence_id", "offset", "ids_crc32"} <= set(docs.columns)
