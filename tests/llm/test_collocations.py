"""Collocations against a plain count of every phrase."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from cases import EDGE, edge_docs, no_docs
from conftest import SF_SMALL
from shiftline.llm import collocations as co
from shiftline.llm import queries

COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def _expected(docs, longest=5, least=100, share=100, top=2000):
    counts, sizes = {}, Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            own = counts.setdefault(lang, Counter())
            for m in range(1, longest + 1):
                own.update(tuple(words[k:k + m]) for k in range(len(words) - m + 1))
    out = []
    for lang, own in counts.items():
        wanted = [(p, a) for p, a in own.items() if len(p) > 1 and a >= least]
        rows = []
        for p, a in wanted:
            inside = any(len(o) > len(p) and share * a <= 100 * f and any(
                o[k:k + len(p)] == p for k in range(len(o) - len(p) + 1)) for o, f in wanted)
            if not inside:
                score, _, l, r = min((1000 * a * sizes[lang] // (own[p[:k]] * own[p[k:]]), k, own[p[:k]], own[p[k:]])
                                     for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, p, l, r) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, p.decode(), -a, l, r, sizes[lang], -score))
    return sorted(out)


def _rows(df):
    return sorted(tuple(r) for r in df.select(*COLUMNS).collect())


def _made(seed, n=300):
    """Texts of few words, with many repeats, breaks and passages."""
    rnd = random.Random(seed)
    words = ["a", "b", "B", "ç", "日", "x\x00y", "it's", "-", "d"]
    line = "the very same line, of many words; again\tand again"
    return [(rnd.choice(["en", "en", "fr", None, "und"]), rnd.choice([line, None, "", "...", " "]) if k % 5 == 0 else
             "".join(rnd.choice(words) + rnd.choice("      \t.,\n\r\x0b") for _ in range(rnd.randrange(40)))) for k in range(n)]


@pytest.mark.parametrize("settings", [
    co.Settings(least=3), co.Settings(least=2, chunk=50, part=10, group=3, bits=6), co.Settings(least=4, share=60, top=9),
    co.Settings(least=5, longest=3, hot=3, group=7, bits=10, hash_bits=9, chunk=200), co.Settings(least=10_000)])
def test_equals_the_plain_count(spark, settings):
    docs = _made(settings.least)
    df = spark.createDataFrame(docs, "lang string, text string").repartition(5)
    want = _expected(docs, settings.longest, settings.least, settings.share, settings.top)
    assert _rows(co.collocations(df, settings)) == want


def test_query(spark):
    docs = [(r.lang, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    assert _rows(queries.op12_collocations(spark, SF_SMALL)) == _expected(docs)


def test_edge_rows(spark):
    small = co.Settings(least=2)
    assert _rows(co.collocations(edge_docs(spark), small)) == _expected([(r[2], r[1]) for r in EDGE], least=2)
    assert co.collocations(no_docs(spark), small).collect() == []


def test_scores_pass_64_bits(spark):
    rows = [("x", a, n, l, r) for a, n, l, r in ((10**13, 10**14, 10**13, 10**13 + 7), (3 * 10**12, 9 * 10**14, 3 * 10**12, 10**13))]
    spark.createDataFrame(rows, "p string, a long, n long, l long, r long").createOrReplaceTempView("cuts")
    big = "CAST({} AS DECIMAL(19, 0))".format
    got = spark.sql(f"SELECT a, ({big('1000 * a')} * {big('n')}) DIV ({big('l')} * {big('r')}) AS s FROM cuts").collect()
    assert {r.a: r.s for r in got} == {a: 1000 * a * n // (l * r) for _, a, n, l, r in rows}


def test_bitmap_never_loses_a_phrase():
    rnd = np.random.default_rng(1)
    h = rnd.integers(0, 1 << 63, 200).astype(np.uint64)
    place = h & np.uint64((1 << 10) - 1)
    cells = np.zeros(16, np.uint64)
    for p in place:
        cells[int(p) >> 6] |= np.uint64(1) << np.uint64(int(p) & 63)
    at = np.flatnonzero(cells)
    assert co.Bitmap(10, at, cells[at]).holds(h).all()
