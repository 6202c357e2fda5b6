"""Near duplicates against all pairs."""

import random

import numpy as np
from pyspark.sql import functions as F

from cases import DOCS, EDGE, SHARED, edge_docs, no_docs
from shiftline.llm import near, queries

SF = "/root/testdata/sf0.01"


def _set(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(zip(*(w[k:] for k in range(5)))) if len(w) >= 5 else frozenset([tuple(w)])


def _expected(docs):
    """doc_id -> (set size, smallest id reachable), every pair of different sets compared."""
    classes = {}
    for doc_id, text in docs:
        classes.setdefault(_set(text), []).append(doc_id)
    sets = [s for s in classes if s]
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = {}
    for k, s in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    for k, s in enumerate(sets):
        for j in {j for x in s for j in where[x] if j < k}:
            common = len(s & sets[j])
            if 100 * common >= 85 * (len(s) + len(sets[j]) - common):
                parent[root(k)] = root(j)
    out, groups = {}, {}
    for k, s in enumerate(sets):
        groups.setdefault(root(k), []).extend(classes[s])
    for ids in groups.values():
        out |= {i: min(ids) for i in ids}
    out |= {i: i for i in classes.get(frozenset(), [])}
    return {i: (len(_set(t)), out[i]) for i, t in docs}


def _check(rows, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in rows}
    assert got == _expected(docs) and len(rows) == len(docs)
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


def _family(rnd, words, members, edits):
    base = [rnd.choice("abcdefghijklmnop") * rnd.randrange(1, 5) + str(k) for k in range(words)]
    for _ in range(members):
        own = list(base)
        for _ in range(rnd.randrange(edits + 1)):
            own[rnd.randrange(words)] = f"new{rnd.random()}"
        yield " ".join(own)


def _docs():
    rnd = random.Random(6)
    texts = [t for words, members, edits in ((150, 60, 4), (40, 12, 1), (400, 8, 6), (7, 6, 1), (12, 10, 1))
             for t in _family(rnd, words, members, edits)]
    chain = [f"c{k}" for k in range(200)]
    for k in range(8):                                   # neighbours are linked, the ends are not
        texts.append(" ".join(chain[6 * k: 6 * k + 120]))
    texts += ["Same TEXT of five words", "same text of five  words", "four words of text", "four words of text", "", None, " "]
    rnd.shuffle(texts)
    return list(enumerate(texts, 3))


def test_links_equal_all_pairs_in_one_and_many_blocks(spark, monkeypatch):
    docs = _docs()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    for block in (512, 5):
        monkeypatch.setattr(near, "BLOCK_SETS", block)
        _check(near.link(df).collect(), docs)
    monkeypatch.setattr(near, "BROADCAST_IDS", 0)
    _check(near.link(df).collect(), docs)


def test_query_equals_all_pairs(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    _check(queries.op7_near_duplicates(spark, SF).collect(), docs)


def test_estimates_are_unbiased_at_every_size():
    rnd = np.random.default_rng(1)
    for n in (1, 3, 30, 300, 5000):
        errors = []
        for _ in range(40):
            a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.unique(np.concatenate([a[: max(1, int(n * 0.9))], rnd.integers(0, 1 << 63, n - max(1, int(n * 0.9))).astype(np.uint64)]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            errors.append(near.estimates(np.stack([near.registers(a), near.registers(b)]), 0)[1] - true)
        assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.12


def test_edge_rows(spark):
    rows = near.link(edge_docs(spark)).collect()
    assert len(rows) == len(EDGE)
    by = {r.doc_id: r for r in rows}
    assert by[7].component_id == by[8].component_id == by[None].component_id == 7
    assert by[1].n_shingles == by[2].n_shingles == by[3].n_shingles == 0 and by[2].kept
    assert by[4].n_shingles == 1 and not by[None].kept
    assert near.link(no_docs(spark)).collect() == []


def test_keep_one_leaves_columns_and_one_row_of_each_group(spark):
    docs = edge_docs(spark)
    kept = near.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(ids) == [1, 2, 3, 4, 5, 6, 7, 9, 10]
    assert near.keep_one(no_docs(spark)).collect() == []
    nameless = spark.createDataFrame([(None, "a b c d e f", None, None, None)] * 3, DOCS)
    assert near.keep_one(nameless).count() == 1
    assert near.keep_one(docs.withColumn("text", F.lit("all the same text now"))).count() == 1


def test_ids_with_two_texts_and_near_copies_without_an_id(spark, monkeypatch):
    docs = spark.createDataFrame(SHARED, DOCS)
    expected = sorted([(2, 2), (3, 2), (3, 2), (9, 2), (21, 20), (20, 20), (21, 20), (30, 30), (30, 30), (40, 40),
                       (-1, 40), (-1, 40), (-1, -1)])
    for block, ids in ((512, near.BROADCAST_IDS), (1, 0)):
        monkeypatch.setattr(near, "BLOCK_SETS", block)
        monkeypatch.setattr(near, "BROADCAST_IDS", ids)
        got = sorted((-1 if r.doc_id is None else r.doc_id, -1 if r.component_id is None else r.component_id)
                     for r in near.link(docs).collect())
        assert got == expected
    left = near.keep_one(docs).collect()
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in left) == [-1, 2, 20, 30, 40]
    assert [r.text for r in left if r.doc_id is None] == ["no id and like no other"]
