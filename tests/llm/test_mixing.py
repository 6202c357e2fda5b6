"""Mixing: targets by plain water filling, quotas by plain highest quotients."""

import heapq
import random
import re

from pyspark.sql import functions as F

from cases import EDGE, edge_docs, no_docs
from conftest import SF_SMALL
from shiftline.llm import mixing, queries


def _size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def _targets(sizes):
    """source -> target for source -> size: share by weight, stop at three times, share the rest again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, out = float(sum(sizes.values())), set(order), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if unit * weight[s] > 3 * sizes[s]}
        for s in over or open_:
            out[s] = 3.0 * sizes[s] if over else unit * weight[s]
            left -= out[s] if over else 0
        open_ -= over or open_
    return out


def _check(rows, docs):
    sizes, source = {}, {}
    for doc_id, text, src in docs:
        sizes[src] = sizes.get(src, 0) + _size(text)
    want, taken, n = _targets(sizes), {}, {}
    for r in rows:
        taken[r.source] = taken.get(r.source, 0) + r.taken
        n[r.source] = n.get(r.source, 0) + 1
        assert 0 <= r.taken <= 3 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - want[r.source]) < 1e-6 * max(1, want[r.source])
    assert len(rows) == len(docs)
    for s, t in want.items():
        shards = sizes[s] // mixing.SHARD_WORDS + 1
        assert abs(taken[s] - t) <= mixing.BLOCK_WORDS * (shards + 1)


def test_query_hits_the_targets_and_reruns_agree(spark, monkeypatch):
    docs = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    rows = queries.op8_mixing(spark, SF_SMALL).collect()
    _check(rows, docs)
    assert sorted(rows) == sorted(queries.op8_mixing(spark, SF_SMALL).collect())
    monkeypatch.setattr(mixing, "SHARD_WORDS", 2000)
    _check(queries.op8_mixing(spark, SF_SMALL).collect(), docs)


def test_uneven_sources(spark):
    rnd = random.Random(9)
    docs = [(k, "w " * rnd.randrange(400), rnd.choice([None, "a", "b", "é", "Z", ""] + ["big"] * 6)) for k in range(400)]
    docs.append((400, "w " * 90_000, "a"))
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    _check(mixing.mix(df).collect(), docs)


def test_apportionment_equals_the_plain_method(spark):
    rnd = random.Random(10)
    rows, want = [], {}
    for g in range(12):
        votes = [rnd.choice([0, 1, 5, rnd.randrange(1, 10_000)]) for _ in range(rnd.randrange(1, 30))]
        seats = rnd.randrange(0, 400)
        rows += [(g, p, v, seats) for p, v in enumerate(votes)]
        won = [0] * len(votes)
        heap = [(-v, p) for p, v in enumerate(votes) if v]
        heapq.heapify(heap)
        for _ in range(seats if heap else 0):
            _, p = heapq.heappop(heap)
            won[p] += 1
            heapq.heappush(heap, (-votes[p] / (2 * won[p] + 1), p))
        want |= {(g, p): n for p, n in enumerate(won) if votes[p]}
    df = spark.createDataFrame(rows, "g int, p int, votes long, seats long")
    got = {(r.g, r.p): r.quota for r in mixing.sainte_lague(df, ["g"], ["p"], "votes", "seats").collect()}
    assert got == want


def test_edge_rows_and_apply(spark):
    _check(mixing.mix(edge_docs(spark)).collect(), [(r[0], r[1], r[3]) for r in EDGE])
    assert mixing.mix(no_docs(spark)).collect() == []
    docs = edge_docs(spark)
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    many = mixed.groupBy("doc_id", "text").count().agg(F.max("count")).first()[0]
    assert many <= 6                                                   # one text stands twice
    assert mixing.apply_mix(no_docs(spark)).collect() == []


def test_plan_is_native(spark):
    plan = queries.op8_mixing(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
