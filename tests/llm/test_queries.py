import math

import duckdb
import pytest
from helpers import collected

import corpus_pipeline
from shelfcast.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "NULL"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracles(spark, key):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got = QUERIES[key](spark, SF)
    want = con.execute(ORACLES[key])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    rows = sorted(tuple(map(cell, r)) for r in want.fetchall())
    assert rows == sorted(tuple(cell(r[c]) for c in names) for r in got.collect())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, n = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        assert 0 < docs.count() <= 3 * n, name
    index = corpus_pipeline.STAGES[4][1](spark, docs, SF)
    assert index.count() == docs.count()
    one = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, index.collect()))


def test_pipeline_on_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
