"""Importance resampling against a plain computation; the radix sort against Python's."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from cases import EDGE, edge_docs, no_docs
from conftest import SF_SMALL
from shiftline.llm import queries, radix, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
TARGET = [(1, "same text for readers"), (2, None), (3, "Word1 of word2, of É日本語"), (4, "")]


def _features(text, longest=1):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[k:k + m]) for k in range(len(words)) for m in range(1, longest + 1) if k + m <= len(words)]
    return [zlib.crc32(r.encode()) % 10000 for r in runs], len(words)


def _expected(docs, target, longest=1, least=20, percent=10):
    cut = [(doc_id, *_features(text, longest)) for doc_id, text in docs]
    s, t = {}, {}
    for counts, texts in ((s, [f for _, f, _ in cut]), (t, [_features(text, longest)[0] for text in target])):
        for found in texts:
            for b in found:
                counts[b] = counts.get(b, 0) + 1
    total_s, total_t = float(sum(s.values())), float(sum(t.values()))
    rows = []
    for doc_id, found, n_words in cut:
        gain = [math.floor(1000 * math.log((t.get(b, 0) + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000))))
                for b in found]
        weight = sum(gain) // len(gain) if gain else 0
        h = int(hashlib.sha256(f"2024:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), n_words))
    able = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    out = [(*r[:4], k if k <= len(able) * percent // 100 else None) for k, r in enumerate(able, 1)]
    return sorted(out + [(*r[:4], None) for r in rows if r[4] < least], key=repr)


def _rows(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


def _target(spark):
    return spark.createDataFrame(TARGET, "item_id long, text string")


def test_query_equals_the_plain_computation(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    assert _rows(queries.op11_importance(spark, SF_SMALL)) == _expected(docs, target)


@pytest.mark.parametrize("longest, piece", [(1, 7), (3, 1 << 20), (3, 50)])
def test_edge_rows(spark, longest, piece):
    settings = resample.Settings(longest=longest, piece=piece, least=3, percent=50)
    docs, texts = [(r[0], r[1]) for r in EDGE], [t for _, t in TARGET]
    if longest == 1:
        docs, df = [d for d in docs if len(d[1] or "") < 10_000], edge_docs(spark).where("coalesce(length(text), 0) < 10000")
    else:
        df = edge_docs(spark)
    assert _rows(resample.resample(df, _target(spark), settings)) == _expected(docs, texts, longest, 3, 50)


def test_empty_tables_and_draw(spark):
    assert resample.resample(no_docs(spark), _target(spark)).collect() == []
    docs = edge_docs(spark)
    no_target = _target(spark).where("false")
    assert _rows(resample.resample(docs, no_target)) == _expected([(r[0], r[1]) for r in EDGE], [])
    settings = resample.Settings(least=3, percent=50)
    drawn = resample.draw(docs, _target(spark), settings)
    want = {r[0] for r in _expected([(r[0], r[1]) for r in EDGE], [t for _, t in TARGET], 1, 3, 50) if r[4]}
    assert drawn.columns == docs.columns and {r.doc_id for r in drawn.collect()} == want


@pytest.mark.parametrize("low, high", [(-5, 5), (0, 40_000), (-(1 << 63), (1 << 63) - 1), (7, 7)])
def test_radix_ranks_equal_a_plain_sort(spark, monkeypatch, low, high):
    monkeypatch.setattr(radix, "BLOCK", 8)
    monkeypatch.setattr(radix, "RUN", 4)
    rnd = random.Random(low + high)
    near = [low, high, (low + high) // 2]
    rows = [(rnd.choice([rnd.randint(low, high), rnd.choice(near), None]), rnd.randint(-2, 2), k % 400) for k in range(600)]
    df = spark.createDataFrame(rows, "a long, b long, c long").repartition(7)
    got = {r["rank"]: (r.a, r.b, r.c) for r in radix.rank(df, [("a", True), ("b", False), ("c", False)], "rank").collect()}
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2]))
    assert [got[k] for k in range(1, len(rows) + 1)] == want


def test_radix_of_a_hot_key_keeps_tasks_small(spark, monkeypatch):
    monkeypatch.setattr(radix, "BLOCK", 16)
    df = spark.range(500).select((F.col("id") % 500).alias("a"), F.lit(3).cast("long").alias("hot"))
    got = radix.rank(df, [("hot", True), ("a", False)], "rank").orderBy("rank").collect()
    assert [r.a for r in got] == list(range(500))
    assert radix.rank(df.where("a < 0"), [("hot", True)], "rank").collect() == []
