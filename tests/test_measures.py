"""BI measures and dashboard semantics on tiny inputs."""

import datetime as dt

from pyspark.sql import functions as F

from shiftline.functions.scalar import week_label
from shiftline.plans import bi, dashboard


def _prod(spark, rows):
    return spark.createDataFrame(rows, "plant_name string, produced_qty double, defective_qty int, "
                                       "downtime_minutes double, energy_consumed_kwh double, failure_event int")


def test_all_zero_produced_group(spark):
    df = _prod(spark, [("A", 0.0, 0, 480.0, 0.0, 1), ("A", 0.0, 0, 0.0, 0.0, 0)])
    r = bi.production_measures(df, "plant_name").collect()[0]
    assert r.defect_rate_pct == 0.0 and r.quality_pct == 100.0 and r.energy_per_unit_kwh == 0.0
    assert r.availability_pct == 50.0 and r.oee_proxy_pct == 50.0 and r.failure_rate_pct == 50.0
    assert r.total_downtime_hrs == 8.0 and r.avg_downtime_per_shift_min == 240.0


def test_maintenance_measures_share(spark):
    df = spark.createDataFrame([("A", "Preventive", 100.0), ("A", "Corrective", 300.0), ("B", "Corrective", 5.0)],
                               "plant_name string, maintenance_type string, cost_inr double")
    got = {r.plant_name: r for r in bi.maintenance_measures(df, "plant_name").collect()}
    assert got["A"].preventive_cost_share_pct == 25.0
    assert got["B"].preventive_maintenance_cost is None and got["B"].preventive_cost_share_pct == 0.0


def test_week_label_monday_to_sunday(spark):
    df = spark.createDataFrame([(dt.date(2025, 9, 7),), (dt.date(2025, 9, 8),)], "d date")
    assert [r.w for r in df.select(week_label("d").alias("w")).collect()] == \
        ["2025-09-01/2025-09-07", "2025-09-08/2025-09-14"]


def test_peak_energy_tie_goes_to_smallest_name(spark):
    df = spark.createDataFrame([("B", 10.0), ("A", 10.0), ("C", 3.0)],
                               "machine_name string, energy_consumed_kwh double")
    assert dashboard.peak_energy_machine(df).collect()[0].machine_name == "A"


def test_empty_filter_result_is_typed_and_empty(spark):
    df = _prod(spark, [("A", 1.0, 0, 1.0, 1.0, 0)]).withColumn("machine_type", F.lit("X"))
    from shiftline.operators.star import filter_fact
    out = filter_fact(df, plants=[], machine_types=None)
    from shiftline.sources.warehouse import is_empty
    assert is_empty(out) and out.columns == df.columns
    k = dashboard.kpi_summary(out).collect()[0]
    assert k.units_produced is None and k.defect_rate_pct is None
