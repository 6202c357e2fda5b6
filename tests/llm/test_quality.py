"""Quality classifier: held-out accuracy, folds, awkward rows."""

import zlib

from pyspark.sql import functions as F

from cases import EDGE, edge_docs, no_docs
from shiftline.llm import quality, queries

SF = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op6_quality(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    held = [d for d in labels if d in rows and rows[d].held_out]
    right = sum(rows[d].predicted == labels[d] for d in held) / len(held)
    assert len(held) > 40 and right >= 0.95


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    turned = labels.withColumn("quality", F.when(fold == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit("y"), "label": F.lit(0), "score": F.lit("z")})
    settings = quality.Settings(sample=150, epochs=2)
    assert sorted(quality.classify(docs, labels, settings).collect()) == \
        sorted(quality.classify(other, turned, settings).collect())


def test_awkward_rows_and_missing_labels(spark):
    labels = spark.createDataFrame([(1, 0, 0), (4, 1, 0), (4, 0, 0), (5, 1, None), (6, None, 0), (7, 1, 0), (None, 1, 1)], LABELS)
    rows = quality.classify(edge_docs(spark), labels).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in EDGE)
    assert len({r.score for r in rows if r.doc_id in (7, 8)}) == 1
    for few in (labels.limit(0), labels.where("quality = 1")):
        assert all(0 <= r.score <= 1 for r in quality.classify(edge_docs(spark), few).collect())
    assert quality.classify(no_docs(spark), labels).collect() == []


def test_blocks_are_cut_at_white_space(monkeypatch):
    import numpy as np
    from shiftline.llm import hashing
    text = "ab cd  ef\n\n" + "long" * 60 + " gh gh gh " * 30
    whole = np.sort(np.concatenate(quality.features(text)))
    monkeypatch.setattr(hashing.blocks, "__defaults__", (16,))
    parts = np.concatenate(quality.features(text))
    words = quality.features("ab cd")[0]
    assert set(words) <= set(parts) and abs(len(parts) - len(whole)) < 0.02 * len(whole)
