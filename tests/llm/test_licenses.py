"""License scans: base places against a plain search, lines by the method."""

import re

from cases import EDGE, edge_docs, no_docs
from conftest import SF_SMALL
from shiftline.llm import licenses, queries

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _base(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(k, label) for label, line in licenses.BASE for p in [line.split()]
              for k in range(len(words)) if words[k:k + len(p)] == p]
    starts = [k for k, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def _check(rows, docs):
    got = sorted((str(r.doc_id), r.n_words, r.n_base, str(r.first_word), str(r.last_word), r.base_labels) for r in rows)
    want = []
    for doc_id, text in docs:
        n, k, lo, hi, labels = _base(text)
        want.append((str(doc_id), n, k, str(lo), str(hi), labels))
    assert got == sorted(want)


TEXTS = ["MIT License", "mit license mit license", "the MIT  license. Apache-License!", "GENERAL PUBLIC LICENSE",
         "general public\nlicence", "general public general public license", "K mit lıcense", "MİT license",
         "mit_license", "apache licensé", "x " * 50 + "apache license " * 30]


def test_base_places(spark):
    docs = list(enumerate(TEXTS)) + [(r[0] if r[0] is None else r[0] + 100, r[1]) for r in EDGE]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    _check(licenses.scan(df).collect(), docs)
    _check(licenses.scan(edge_docs(spark)).collect(), [(r[0], r[1]) for r in EDGE])
    assert licenses.scan(no_docs(spark)).collect() == []


def test_lines_with_changed_words(spark):
    docs = [(0, "This work is licensed under the GNU General Public License, version 3."),
            (1, "This work is hereby licensed under the GNU Public License, version 3"),
            (2, "Licensed under CC BY-NC 4.0."), (3, "under the stars we work, version 3"),
            (4, "x " * 90 + "Redistribution and use in source and binary forms, with or without any modification")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert [got[k].labels for k in range(5)] == ["gpl", "", "cc-by-nc", "", "bsd"]
    assert got[0].score == 1.0 and 0 < got[1].score < 1 and 0 <= got[3].score < 0.8


def test_query_and_plan(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = queries.op4_licenses(spark, SF_SMALL)
    _check(df.collect(), docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
