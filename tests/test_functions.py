"""Scalar helpers (X1–X15) on literal inputs."""

import datetime as dt

from pyspark.sql import functions as F

from shiftline.functions import scalar as X


def _one(spark, col):
    return spark.range(1).select(col.alias("v")).first().v


def test_rounding(spark):
    assert _one(spark, X.round_to(F.lit(2.675), 2, exact_scale=3)) == 2.68        # decimal tie, away from 0
    assert _one(spark, X.round_to(F.lit(-2.5), 0, exact_scale=1)) == -3.0
    assert [_one(spark, X.round_half_even_int(F.lit(v))) for v in (10.5, 11.5, 10.6, 0.5)] == [10, 12, 11, 0]


def test_safe_divide(spark):
    assert _one(spark, X.safe_divide(F.lit(1.0), F.lit(0.0))) is None
    assert _one(spark, X.safe_divide(F.lit(1.0), F.lit(0.0), 0.0)) == 0.0
    assert _one(spark, X.safe_divide(F.lit(3), F.lit(4))) == 0.75


def test_calendar_helpers(spark):
    d = F.lit(dt.date(2025, 9, 6))
    assert _one(spark, X.date_key(d)) == "20250906"
    assert _one(spark, X.key_to_date(F.lit("20250906"))) == dt.date(2025, 9, 6)
    assert _one(spark, X.day_name(d)) == "Saturday"
    assert _one(spark, X.weekend_flag(d)) == 1
    assert _one(spark, X.weekend_flag(F.lit(dt.date(2025, 9, 5)))) == 0
    assert _one(spark, X.week_start(d)) == dt.date(2025, 9, 1)
    assert _one(spark, X.week_label(d)) == "2025-09-01/2025-09-07"
    assert abs(_one(spark, X.age_years(F.lit(dt.date(2026, 3, 31)), F.lit(dt.date(2016, 3, 31)))) - 10.0) < 0.01


def test_ids_clamp_flags(spark):
    assert _one(spark, X.padded_id("M", F.lit(7), 3)) == "M007"
    assert _one(spark, X.padded_id("MT", F.lit(42), 5)) == "MT00042"
    assert _one(spark, X.clamp(F.lit(5.0), 0.0, 4.0)) == 4.0
    assert _one(spark, X.clamp(F.lit(-1.0), 0.0)) == 0.0
    assert [_one(spark, X.to_flag(F.lit(v))) for v in ("True", "false", "1", "0", "maybe")] == [1, 0, 1, 0, None]
    assert _one(spark, X.is_valid_number(F.lit(float("nan")))) is False
    assert _one(spark, X.is_valid_number(F.lit(None).cast("double"))) is False
    assert _one(spark, X.is_valid_number(F.lit(0.0))) is True


def test_exact_sum_is_order_independent(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1e6, -1e6]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    got = df.agg(X.exact_sum("x").alias("s"), X.exact_avg("x").alias("a")).first()
    assert got.s == 3.0 and got.a == 3.0 / len(vals)
