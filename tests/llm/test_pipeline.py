"""The registered queries and the pipeline on generated tables."""

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallyframe.llm import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for t in ("documents", "pages", "labels", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_all_are_registered():
    names = contract.queries()
    assert [n for n in range(1, 14) if not any(x.startswith(f"op{n}_") for x in names)] == []
    assert "pipeline" in names and set(queries.ORACLES) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", queries.ORACLES)
def test_query_matches_oracle(spark, oracle, name):
    df = queries.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    result = oracle.execute(queries.ORACLES[name])
    at = [[d[0] for d in result.description].index(c) for c in columns]
    assert got == sorted((tuple(r[i] for i in at) for r in result.fetchall()), key=repr)


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns
        if name in ("quality", "exact_dedup", "near_dedup"):
            assert docs.count() < before or name == "near_dedup" and docs.count() <= before
        before = docs.count()
        assert before
    again = corpus_pipeline.run(spark, SMALL)
    assert sorted((r.doc_id, r.n_tokens) for r in again.collect()) == sorted((r.doc_id, r.n_tokens) for r in docs.collect())


def test_stages_of_empty_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        assert docs.collect() == []
