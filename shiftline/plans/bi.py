"""The BI semantic model: measures D1–D16 and page views V1–V12.

``production_measures(df, *groups)`` / ``maintenance_measures(df, *groups)``
evaluate the whole measure set as one aggregate over any grouping, so every
page view is one ``groupBy`` whose shuffle carries partial aggregates only.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions import measures as M
from shiftline.functions.scalar import age_years, date_key, decimal_sum, key_to_date, week_label
from shiftline.operators.aggregate import aggregate_by_attributes
from shiftline.operators.calendar import calendar_dim
from shiftline.operators.star import Star


def production_measures(fact: DataFrame, *group_cols: str, names=None, star: Star | None = None) -> DataFrame:
    """D1–D12 per group (one row overall when no group columns).

    Group columns may be fact columns or dimension attributes; with a
    ``star`` the attributes are looked up after pre-aggregation when their
    dimension is too large to broadcast (``aggregate_by_attributes``).
    """
    partials = M.production_partials()
    if group_cols:
        g = aggregate_by_attributes(star, fact, list(group_cols), partials)
    else:
        g = fact.agg(*[c.alias(n) for n, c in partials.items()])
    out = g.select(*group_cols, *M.over_partials(M.production_finals, partials, names))
    return out.orderBy(*group_cols) if group_cols else out


def maintenance_measures(fact: DataFrame, *group_cols: str, names=None, star: Star | None = None) -> DataFrame:
    """D13–D16 per group."""
    partials = M.maintenance_partials()
    if group_cols:
        g = aggregate_by_attributes(star, fact, list(group_cols), partials)
    else:
        g = fact.agg(*[c.alias(n) for n, c in partials.items()])
    out = g.select(*group_cols, *M.over_partials(M.maintenance_finals, partials, names))
    return out.orderBy(*group_cols) if group_cols else out


def executive_overview(prod: DataFrame, maint: DataFrame) -> DataFrame:
    """V1: KPI cards D1, D9, D10, D12 and D13 as one row.

    The maintenance total is a scalar subquery over the maintenance fact,
    so the two one-row aggregates are combined without a join.
    """
    cost = maint.agg(M.measure("total_maintenance_cost")).scalar()
    cards = ["total_units_produced", "failure_rate_pct", "availability_pct", "oee_proxy_pct"]
    return prod.agg(*[M.measure(n).alias(n) for n in cards]).select("*", cost.alias("total_maintenance_cost"))


def production_by_plant(prod: DataFrame, star: Star | None = None) -> DataFrame:
    """V3: units produced by plant."""
    return production_measures(prod, "plant_name", names=["total_units_produced"], star=star)


def plant_category_matrix(prod: DataFrame, wide: bool = False, categories=None,
                          star: Star | None = None) -> DataFrame:
    """V4: plant × category with D1 and D3.

    Long form by default. ``wide=True`` pivots categories into columns of
    units produced: the (plant, category) totals are aggregated first
    (through the dimensions, size-chosen), so only that small table is
    pivoted. Pass ``categories`` to avoid the extra job that finds the
    distinct values (Spark caps a pivot at ``spark.sql.pivotMaxValues``); units
    of all other categories, and of none, are in the column ``other``.
    """
    if not wide:
        return production_measures(prod, "plant_name", "category",
                                   names=["total_units_produced", "defect_rate_pct"], star=star)
    cells = aggregate_by_attributes(star, prod, ["plant_name", "category"], {"_u": decimal_sum("produced_qty")})
    g = cells.groupBy("plant_name")
    if categories is None:
        return g.pivot("category").agg(F.sum("_u").cast("double")).orderBy("plant_name")
    # Units of any category that is not listed stay visible.
    listed = cells.withColumn("category", F.when(F.col("category").isin(categories), F.col("category")).otherwise("other"))
    return listed.groupBy("plant_name").pivot("category", [*categories, "other"]).agg(
        F.sum("_u").cast("double")).orderBy("plant_name")


def defect_rate_trend(prod: DataFrame, machine_types=None, by: str = "week") -> DataFrame:
    """V5: D3 over time (week label or day), optionally for some machine types."""
    if machine_types is not None:
        prod = prod.where(F.col("machine_type").isin(list(machine_types)))
    period = week_label("date").alias("period") if by == "week" else F.col("date").alias("period")
    names = ["total_defective_units", "total_units_produced", "defect_rate_pct"]
    return prod.groupBy(period).agg(*[M.measure(n).alias(n) for n in names]).orderBy("period")


def energy_per_unit_vs_age(star: Star, as_of: _dt.date, prod: DataFrame | None = None) -> DataFrame:
    """V8: per machine, D7 and age in years at ``as_of`` (an explicit date,
    never the wall clock, so reruns agree). Aggregated on machine_id before
    the machine lookup. ``prod``: a filtered fact instead of the whole one."""
    per = (star.fact_production if prod is None else prod).groupBy("machine_id").agg(
        M.measure("total_energy_kwh").alias("total_energy_kwh"),
        M.measure("total_units_produced").alias("total_units_produced"))
    m = star.dim("dim_machine", "machine_id", "machine_name", "machine_type", "install_date")
    out = per.join(m, "machine_id")
    return out.select("machine_id", "machine_name", "machine_type", "install_date",
                      age_years(F.lit(as_of), "install_date").alias("machine_age_years"),
                      "total_energy_kwh", "total_units_produced",
                      F.coalesce(F.try_divide("total_energy_kwh", "total_units_produced"), F.lit(0.0))
                      .alias("energy_per_unit_kwh")).orderBy("machine_id")


def same_period_last_year(prod: DataFrame, star: Star | None = None) -> DataFrame:
    """Monthly units per plant next to the same month one year earlier.

    Monthly totals are small (plants × months); the prior-year value is an
    equi-join of that table with itself on (plant, year − 1, month).
    """
    monthly = aggregate_by_attributes(star, prod, ["plant_name", "year", "month"],
                                      {"_u": decimal_sum("produced_qty")})
    monthly = monthly.select("plant_name", "year", "month", F.col("_u").cast("double").alias("units"))
    prev = monthly.select("plant_name", (F.col("year") + 1).alias("year"), "month",
                          F.col("units").alias("units_same_period_last_year"))
    out = monthly.join(prev, ["plant_name", "year", "month"], "left")
    return out.select("plant_name", "year", "month", F.col("units").alias("total_units_produced"),
                      "units_same_period_last_year",
                      (F.col("units") - F.col("units_same_period_last_year")).alias("yoy_change")
                      ).orderBy("plant_name", "year", "month")


def shifted_days(star: Star, months: int = -12) -> DataFrame:
    """Bridge of the calendar: ``date`` and the day ``months`` away, as ``other_id``.

    Every day from the fact's first to its last is there, whether or not it has
    a row in ``dim_date``. 29 February goes to the 28th where there is no 29th,
    as ``add_months`` has it. Bounded by the calendar.
    """
    span = star.fact_production.agg(key_to_date(F.min("date_id")).alias("start"), key_to_date(F.max("date_id")).alias("end"))
    return calendar_dim(span).select("date", date_key(F.add_months("date", months)).alias("other_id"))


def same_period_by(prod: DataFrame, star: Star, grain: str, group: str = "plant_name", months: int = -12) -> DataFrame:
    """V12 at any grain: units per ``group`` and day, week or month next to the same days a year before.

    A period's days are shifted as a set: each earlier day counts once, however
    many days of the period are shifted to it. The fact is summed by day first,
    so the bridge meets days and groups, never rows. Columns: group, period,
    total_units_produced, units_same_period_last_year, yoy_change.
    """
    period = {"day": lambda d: F.col(d).cast("string"), "week": week_label, "month": lambda d: F.date_format(d, "yyyy-MM")}[grain]
    daily = aggregate_by_attributes(star, prod, [group, "date_id"], {"_u": decimal_sum("produced_qty")})
    daily = daily.withColumn("date", key_to_date("date_id"))
    now = daily.groupBy(group, period("date").alias("period")).agg(F.sum("_u").alias("_now"))
    bridge = shifted_days(star, months).select(period("date").alias("period"), "other_id").distinct()
    earlier = daily.join(bridge, F.col("date_id") == F.col("other_id")).groupBy(group, "period").agg(F.sum("_u").alias("_then"))
    out = now.join(earlier, [group, "period"], "left").select(
        group, "period", F.col("_now").cast("double").alias("total_units_produced"),
        F.col("_then").cast("double").alias("units_same_period_last_year"))
    return out.withColumn("yoy_change", F.col("total_units_produced") - F.col("units_same_period_last_year")).orderBy(
        group, "period")

