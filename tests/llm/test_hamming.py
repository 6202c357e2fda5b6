"""Exact top-k against brute force."""

import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shiftline.llm import hamming, queries


def _code(v):
    return None if v is None else sum(1 << i for i, x in enumerate(v) if x is not None and x > 0)


def _expected(rows, k):
    coded = [(i, _code(v)) for i, v in rows if v is not None]
    out = set()
    for i, c in coded:
        if i is not None and i % 50 == 0:
            near = sorted((bin(c ^ d).count("1"), j) for j, d in coded if j is not None and j != i)[:k]
            out |= {(i, rank, j, dist) for rank, (dist, j) in enumerate(near, 1)}
    return out


def _rows(n=900):
    rnd = random.Random(5)
    centres = [[rnd.uniform(-1, 1) for _ in range(64)] for _ in range(6)]
    rows = []
    for i in range(n):
        c = centres[rnd.randrange(6)]
        rows.append((i, list(c) if i % 3 == 0 else [x if rnd.random() < 0.9 else -x for x in c]))
    return rows + [(1000, None), (1050, [None] * 64), (1100, []), (1150, [rnd.uniform(-1, 1) for _ in range(70)])]


def test_search_equals_brute_force_in_one_and_many_blocks(spark, monkeypatch):
    rows = _rows()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("code", F.lit("clash"))
    for codes, asked in ((1 << 16, 1 << 10), (60, 4)):
        monkeypatch.setattr(hamming, "BLOCK_CODES", codes)
        monkeypatch.setattr(hamming, "BLOCK_QUERIES", asked)
        got = {tuple(r) for r in hamming.search(df, F.col("vec_id") % 50 == 0, 10).collect()}
        assert got == _expected(rows, 10)


def test_wide_vectors_nan_and_rows_without_an_id(spark):
    rnd = random.Random(7)
    for width in (70, 128, 768):
        base = [rnd.choice([-1.0, 1.0]) for _ in range(width)]
        rows = [(i, [x if rnd.random() < 0.8 else rnd.choice([-x, float("nan"), None]) for x in base][: width - i % 3])
                for i in range(160)] + [(None, base), (200, base[:64]), (250, None)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        got = {tuple(r) for r in hamming.search(df, F.col("vec_id") % 50 == 0, 10).collect()}
        assert got == _expected([r for r in rows if r[0] is not None], 10)


def test_few_rows_and_no_rows(spark):
    rows = [(0, [1.0] * 64), (50, [1.0] * 64), (7, [-1.0] * 64)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {tuple(r) for r in hamming.search(df, F.col("vec_id") % 50 == 0, 10).collect()} == _expected(rows, 10)
    assert hamming.search(df.limit(0), F.col("vec_id") % 50 == 0, 10).collect() == []


def test_query_equals_brute_force(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    assert {tuple(r) for r in queries.op3_topk(spark, SF_SMALL).collect()} == _expected(rows, 10)
