"""Totals, splits and scores where a cut, an overflow or a dropped row would show."""

import math

import pytest
from pyspark.sql import functions as F

from shiftline.functions.scalar import exact_avg, exact_sum
from shiftline.operators import evaluation, ranking
from shiftline.plans import risk


def test_totals_keep_every_decimal(spark):
    values = [0.00004, 0.00004, 1234567.891, -0.000000125, 3.3]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    r = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert r.s == math.fsum(values) and r.a == math.fsum(values) / 5
    small = spark.createDataFrame([(0.00004,), (0.00004,)], "x double").agg(exact_sum("x").alias("s")).first()
    assert small.s == 0.00008


def test_nan_is_missing_and_overflow_raises(spark):
    df = spark.createDataFrame([(1.5,), (float("nan"),), (None,)], "x double")
    r = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a")).first()
    assert (r.s, r.a) == (1.5, 1.5)
    with pytest.raises(Exception, match="(?i)overflow|cannot be represented|out of range"):
        spark.createDataFrame([(1e30,)], "x double").agg(exact_sum("x")).collect()


def test_split_refuses_null_labels(spark):
    df = spark.range(100).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 2).cast("int").alias("y"))
    with pytest.raises(Exception, match="y is null"):
        ranking.stratified_split(df, "y", ["id"]).collect()


def test_auc_of_many_rows_does_not_overflow(spark):
    """Counts whose product passes bigint, as one row for each score would give them at scale."""
    n = F.lit(4_000_000_000).cast("long")
    wide = lambda c: c.cast("decimal(19,0)")
    assert spark.range(1).select((wide(n) * wide(n)).cast("double").alias("p")).first().p == 1.6e19
    df = spark.createDataFrame([(0, 0.1), (1, 0.4), (0, 0.4), (1, 0.9)], "label int, score double")
    assert evaluation.roc_auc(df).first().roc_auc == 0.875


@pytest.mark.parametrize("losses, at", [([5, 4, 3], None), ([5, 4] + [4] * 10, 12), ([5] + [6] * 9 + [4] + [4] * 10, 21),
                                        ([3] + [4] * 10, 11)])
def test_fit_stops_after_ten_rounds_without_gain(losses, at):
    assert risk.stop_round([float(x) for x in losses], 10, 1e-7) == at


def test_importance_of_some_features(spark):
    rows = [(f"M{k}", "20250101", "S1", int(k % 3 == 0), float(k % 3 == 0), float(k)) for k in range(300)]
    df = spark.createDataFrame(rows, "machine_id string, date_id string, shift_id string, failure_event int, a double, b double")
    got = risk.importance(df, lambda d: d.withColumn("prediction", (F.col("a") > 0.5).cast("int")), ["b", "a"], 3).collect()
    assert [r.feature for r in got] == ["b", "a"]
    assert got[0].importance_mean == 0.0 and 0.3 < got[1].importance_mean < 0.6
    only = risk.importance(df, lambda d: d.withColumn("prediction", (F.col("a") > 0.5).cast("int")), ["a"], 3).collect()
    assert only[0].importance_mean == got[1].importance_mean
