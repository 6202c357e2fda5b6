"""The pipeline: stages' columns, what each drops, oracles of the queries."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from cases import edge_docs, no_docs
from shiftline.llm import bpe, near, queries
from shiftline.llm.common import table, written

SF = "/root/testdata/sf0.01"


def test_stages_in_order(spark):
    docs = table(spark, SF, "documents")
    labels = {r.doc_id: r.quality for r in table(spark, SF, "labels").collect()}
    before, columns = {r.doc_id for r in docs.select("doc_id").collect()}, docs.dtypes
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SF), f"test-{name}")
        ids = [r.doc_id for r in out.select("doc_id").collect()]
        assert out.dtypes == columns and set(ids) <= before
        if name == "quality":
            assert {d for d, q in labels.items() if q == 1 and d in before} <= set(ids)
            assert not {d for d, q in labels.items() if q == 0} & set(ids)
        if name == "language":
            assert set(ids) == before                     # all documents have a known language
        if name == "near_duplicates":
            want = {r.doc_id for r in near.link(docs).where("kept").collect()}
            assert set(ids) == want and len(ids) == len(want)
        docs, before = out, set(ids)
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert sorted(rows) == sorted(bpe.digests(docs, queries.BYTE_BPE).collect()) and len(rows) == docs.count()


@pytest.mark.parametrize("make", [edge_docs, no_docs])
def test_stages_take_awkward_and_no_rows(spark, make):
    for name, stage in corpus_pipeline.STAGES:
        docs = make(spark)
        out = stage(spark, docs, SF)
        assert name == "bpe" or out.columns == docs.columns
        assert out.count() <= 3 * docs.count()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_matches_oracle(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.QUERIES[name](spark, SF)
    cursor = con.execute(queries.ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(tuple, df.select(names).collect()), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_all_queries_are_registered():
    named = E.queries()
    assert "pipeline" in named
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in named) == 1
