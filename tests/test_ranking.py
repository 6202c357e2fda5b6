"""Exact split, positions, permutation and AUC vs brute force."""

import hashlib
import math
import random

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from shiftline.operators import evaluation, ranking


def test_positions_match_sorted_order(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("g"))
    df = df.withColumn("k", ranking.digest(5, "id"))
    got = {(r.g, r.id): r.pos for r in ranking.positions(df, "k", ["g"], digits=2).collect()}
    for g in range(3):
        ids = sorted((i for i in range(3000) if i % 3 == g),
                     key=lambda i: hashlib.md5(f"5|{i}".encode()).hexdigest())
        assert [got[(g, i)] for i in ids] == list(range(1, len(ids) + 1))


def test_positions_by_the_bytes_of_a_digest(spark):
    df = spark.range(3000).select(F.col("id"), (F.col("id") % 3).alias("g"), ranking.digest(5, "id").alias("k"))
    plain = {(r.g, r.id): r.pos for r in ranking.positions(df, "k", ["g"]).collect()}
    short = ranking.positions(df.withColumn("k", F.unhex("k")), "k", ["g"], digits=1)
    assert {(r.g, r.id): r.pos for r in short.collect()} == plain


def test_stratified_split_is_exact_and_matches_brute_force(spark):
    n = 5000
    df = spark.range(n).select(F.col("id").cast("string").alias("k"),
                               (F.col("id") % 50 == 0).cast("int").alias("y"))
    out = ranking.stratified_split(df, "y", ["k"], test_percent=20, seed=42, digits=2).collect()
    test = {r.k for r in out if r.is_test == 1}
    assert len(out) == n
    for y in (0, 1):
        ks = [str(i) for i in range(n) if int(i % 50 == 0) == y]
        ks.sort(key=lambda k: hashlib.md5(f"42|{k}".encode()).hexdigest())
        want = set(ks[:math.ceil(len(ks) * 20 / 100)])
        assert want == {k for k in test if int(int(k) % 50 == 0) == y}


def _auc_brute(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    tot = sum((1.0 if p > q else 0.5 if p == q else 0.0) for p in pos for q in neg)
    return tot / (len(pos) * len(neg))


def test_roc_auc_exact_with_ties(spark):
    rnd = random.Random(3)
    pairs = [(round(rnd.random(), 2), int(rnd.random() < 0.3)) for _ in range(2000)]
    df = spark.createDataFrame(pairs, "score double, label int")
    got = evaluation.roc_auc(df, "label", "score", n_buckets=16).collect()[0]
    assert abs(got.roc_auc - _auc_brute(pairs)) < 1e-12
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    assert abs(got.roc_auc - ev.evaluate(df.withColumn("label", F.col("label").cast("double")))) < 1e-9


def test_classification_report_matches_definitions(spark):
    pairs = [(1, 1)] * 3 + [(1, 0)] * 2 + [(0, 1)] * 4 + [(0, 0)] * 11
    df = spark.createDataFrame(pairs, "label int, prediction int")
    rep = {r.class_label: r for r in evaluation.classification_report(df).collect()}
    p1, r1 = 3 / 7, 3 / 5
    assert abs(rep["1"].precision - p1) < 1e-12 and abs(rep["1"].recall - r1) < 1e-12
    assert abs(rep["1"].f1_score - 2 * p1 * r1 / (p1 + r1)) < 1e-12
    assert rep["accuracy"].f1_score == 14 / 20 and rep["accuracy"].support == 20
    p0, r0 = 11 / 13, 11 / 15
    assert abs(rep["macro avg"].precision - (p0 + p1) / 2) < 1e-12
    assert abs(rep["weighted avg"].recall - (r0 * 15 + r1 * 5) / 20) < 1e-12


def test_time_split_holds_out_latest_rows_per_class(spark):
    rows = [(f"2024{m:02d}{d:02d}", s, f"M{k}", int((m * 31 + d + k) % 9 == 0))
            for m in range(1, 13) for d in range(1, 29) for s in ("S1", "S2", "S3") for k in range(3)]
    df = spark.createDataFrame(rows, "date_id string, shift_id string, machine_id string, y int")
    out = ranking.time_split(df, "y", ["date_id", "shift_id", "machine_id"], test_percent=20).collect()
    assert len(out) == len(rows)
    for y in (0, 1):
        keys = sorted(f"{r.date_id}|{r.shift_id}|{r.machine_id}" for r in out if r.y == y)
        want = set(keys[len(keys) - math.ceil(len(keys) * 20 / 100):])
        got = {f"{r.date_id}|{r.shift_id}|{r.machine_id}" for r in out if r.y == y and r.is_test == 1}
        assert got == want
