"""Winnowing against a slow version; neighbours by descending id."""

import hashlib
import random

import numpy as np

from cases import DOCS, EDGE, edge_docs, no_docs
from conftest import SF_SMALL
from shiftline.llm import hashing, queries, winnow

MASK = (1 << 64) - 1


def _mix(x):
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & MASK
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & MASK
    return x ^ (x >> 31)


def _slow(text, k=winnow.K, window=winnow.WINDOW):
    codes = [ord(c) + 1 for c in text]
    if not codes:
        return [], []
    k = min(k, len(codes))
    grams = []
    for i in range(len(codes) - k + 1):
        h = 0
        for c in codes[i:i + k]:
            h = (h * hashing.BASE + c) & MASK
        grams.append(_mix(h))
    window = min(window, len(grams))
    kept = []
    for i in range(len(grams) - window + 1):
        low = min(grams[i:i + window])
        at = max(j for j in range(i, i + window) if grams[j] == low)
        if not kept or kept[-1] != at:
            kept.append(at)
    return [grams[j] for j in kept], kept


def test_fingerprint_equals_the_slow_one(monkeypatch):
    rnd = random.Random(2)
    for block in (64, 1 << 18):
        monkeypatch.setattr(winnow, "BLOCK", block)
        for n in [0, 1, 2, 15, 16, 17, 30, 31, 32, 33, 200, 500]:
            for letters in ("ab", "abcdefg é🎉"):
                text = "".join(rnd.choice(letters) for _ in range(n))
                hashes, positions = winnow.fingerprint(text)
                assert (hashes.tolist(), positions.tolist()) == _slow(text)


def test_shared_passages_are_always_found():
    rnd = random.Random(3)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    for _ in range(200):
        passage = word(winnow.K + winnow.WINDOW - 1)
        a, b = (winnow.fingerprint(word(rnd.randrange(80)) + passage + word(rnd.randrange(80)))[0] for _ in range(2))
        assert len(np.intersect1d(a, b))


def _expected(docs):
    order = sorted(docs, key=lambda r: (r[0] is None, -(r[0] or 0)))
    for k, (doc_id, text) in enumerate(order):
        following = order[(k + 1) % len(order)][1]
        n = len(text) // 3
        yield doc_id, text, text[:len(text) - n] + following[:n], following


def _jaccard(a, b):
    a, b = set(_slow(a)[0]), set(_slow(b)[0])
    return len(a & b) / len(a | b) if a | b else 1.0


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = {r.doc_id: r for r in queries.op5_winnowing(spark, SF_SMALL).collect()}
    assert len(got) == len(docs)
    for k, (doc_id, text, edited, following) in enumerate(_expected(docs)):
        r = got[doc_id]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if k < 25:
            assert abs(r.near_edited - _jaccard(text, edited)) < 1e-12
            assert abs(r.near_next - _jaccard(text, following)) < 1e-12


def test_edge_rows(spark):
    rows = winnow.with_next(edge_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in EDGE)
    prints = {}
    for r in rows:
        prints.setdefault(r.n_chars, set()).add(r.fingerprint)
    assert len(prints[42]) == 1                                   # equal texts, equal fingerprints
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)
    assert winnow.with_next(no_docs(spark)).collect() == []
    one = winnow.with_next(spark.createDataFrame([(1, "abc" * 30, None, None, None)], DOCS)).first()
    assert one.near_next == 1.0
    kept = winnow.fingerprints(edge_docs(spark)).where("doc_id = 5").first()
    assert len(kept.hashes) == len(kept.positions) > 100
