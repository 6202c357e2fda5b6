"""The exploration dashboard's data.

``filtered_production`` applies the sidebar filters; each view is then a
single aggregate. Because the loaded fact has passed the referential
checks against the same dimensions, a dimension that neither a filter nor
the view needs can be left out of the join without changing any row
(this is the wide join J6 with unused lookups eliminated). Views grouped
by a dimension attribute take the ``star`` and look the attribute up after
pre-aggregation when that dimension is too large to broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.functions.scalar import decimal_sum, exact_avg, exact_sum, safe_divide, week_label
from shiftline.operators.aggregate import aggregate_by_attributes
from shiftline.operators.star import Star, attach_attrs, date_bounds, filter_fact


def filtered_production(star: Star, plants=None, machine_types=None, start=None, end=None,
                        attrs=(), calendar: Column | None = None) -> DataFrame:
    """production rows passing the filters, with ``attrs`` attached.

    * A plant or machine-type filter becomes a semi-join of the fact with
      the *qualifying keys* of that dimension. That key set is usually
      small even when the dimension is not; the planner, and AQE by its
      size at run time, broadcast it, so the fact is not shuffled for a
      filter.
    * The date range is applied to the fact's own ``date_id`` key
      (``yyyyMMdd`` sorts like the date), so it reaches the fact scan as a
      pushed-down range predicate, and to the calendar's ``date`` as the
      dashboard defines it.
    * ``calendar`` is a condition on ``dim_date`` (year, quarter, month ...);
      the days that satisfy it prune the fact's month folders.
    """
    lo, hi = date_bounds(start, end)
    if calendar is not None:
        f = star.in_calendar("fact_production", calendar if lo is None else calendar & F.col("date").between(lo, hi))
    else:
        f = star.fact_production if lo is None else star.between("fact_production", lo, hi)
    if plants is not None:
        keys = star.dim_plant.where(F.col("plant_name").isin(list(plants))).select("plant_id")
        f = f.join(keys, "plant_id", "left_semi")
    if machine_types is not None:
        keys = star.dim_machine.where(F.col("machine_type").isin(list(machine_types))).select("machine_id")
        f = f.join(keys, "machine_id", "left_semi")
    need = list(attrs) + (["date"] if lo is not None else [])
    f = attach_attrs(star, f, list(dict.fromkeys(need)))
    return filter_fact(f, None, None, lo, hi)


def filtered_maintenance(star: Star, plants=None, machine_types=None, start=None, end=None) -> DataFrame:
    """Maintenance events for the maintenance views, as fact rows.

    The dashboard's maintenance tab filters on plant only (F5); the BI
    pages sync all slicers (F9), so machine type and date range may be
    given too (quirk K3: both behaviours are available). Plant and type
    filters are semi-joins with the qualifying machines; no attribute is
    attached, views look up what they need.
    """
    lo, hi = date_bounds(start, end)
    m = star.fact_maintenance if lo is None else star.between("fact_maintenance", lo, hi)
    if plants is not None or machine_types is not None:
        machines = star.dim_machine
        if machine_types is not None:
            machines = machines.where(F.col("machine_type").isin(list(machine_types)))
        if plants is not None:
            own = star.dim_plant.where(F.col("plant_name").isin(list(plants))).select("plant_id")
            machines = machines.join(own, "plant_id", "left_semi")
        m = m.join(machines.select("machine_id"), "machine_id", "left_semi")
    return m


# --------------------------------------------------------------------------- A1–A11
def kpi_summary(df: DataFrame) -> DataFrame:
    """A1: units, mean downtime, defect rate %, energy, failure events."""
    return df.agg(
        exact_sum("produced_qty").alias("units_produced"),
        exact_avg("downtime_minutes").alias("avg_downtime_minutes"),
        (safe_divide(F.sum("defective_qty").cast("double"), exact_sum("produced_qty")) * 100.0)
        .alias("defect_rate_pct"),
        exact_sum("energy_consumed_kwh").alias("total_energy_kwh"),
        F.sum("failure_event").cast("bigint").alias("failure_events"),
    )


def weekly_production(df: DataFrame) -> DataFrame:
    """A2 / V2: produced units per Monday–Sunday week."""
    return (df.groupBy(week_label("date").alias("week"))
            .agg(exact_sum("produced_qty").alias("produced_qty")).orderBy("week"))


def production_by_category(fact: DataFrame, star: Star | None = None) -> DataFrame:
    """A3 (category comes from the product dimension when not on ``fact``)."""
    g = aggregate_by_attributes(star, fact, ["category"], {"_u": decimal_sum("produced_qty")})
    return (g.select("category", F.col("_u").cast("double").alias("produced_qty"))
            .orderBy(F.desc("produced_qty"), "category"))


def defect_rate_by_plant(fact: DataFrame, star: Star | None = None) -> DataFrame:
    """A4: ratio of sums per plant."""
    g = aggregate_by_attributes(star, fact, ["plant_name"],
                                {"_p": decimal_sum("produced_qty"),
                                 "_d": F.sum("defective_qty").cast("bigint")})
    produced, defective = F.col("_p").cast("double"), F.col("_d").cast("bigint")
    return g.select("plant_name", produced.alias("produced"), defective.alias("defective"),
                    (safe_divide(defective.cast("double"), produced) * 100.0).alias("defect_rate_pct")
                    ).orderBy("plant_name")


def energy_by_machine_name(fact: DataFrame, star: Star | None = None, k: int = 10) -> DataFrame:
    """A5: energy by machine *name* (names repeat across plants), top k."""
    g = aggregate_by_attributes(star, fact, ["machine_name"], {"_e": decimal_sum("energy_consumed_kwh")})
    return (g.select("machine_name", F.col("_e").cast("double").alias("energy_consumed_kwh"))
            .orderBy(F.desc("energy_consumed_kwh"), "machine_name").limit(k))


def downtime_by_machine_type(fact: DataFrame, star: Star | None = None) -> DataFrame:
    """Mean downtime per shift by machine type."""
    g = aggregate_by_attributes(star, fact, ["machine_type"],
                                {"_s": decimal_sum("downtime_minutes"), "_n": F.count("downtime_minutes")})
    return (g.select("machine_type", safe_divide(F.col("_s").cast("double"), F.col("_n"))
                     .alias("downtime_minutes")).orderBy(F.desc("downtime_minutes"), "machine_type"))


def peak_energy_machine(fact: DataFrame, star: Star | None = None) -> DataFrame:
    """The machine name with the largest total energy (ties → smallest name)."""
    return energy_by_machine_name(fact, star, 1).select(
        "machine_name", F.col("energy_consumed_kwh").alias("total_energy_kwh"))


def cost_by_maintenance_type(mdf: DataFrame) -> DataFrame:
    """A8 / V9."""
    return (mdf.groupBy("maintenance_type").agg(exact_sum("cost_inr").alias("cost_inr"))
            .orderBy("maintenance_type"))


def maintenance_cost_by_plant(mdf: DataFrame, star: Star) -> DataFrame:
    """Cost by the machine's plant; summed per machine before the lookups."""
    per_machine = mdf.groupBy("machine_id").agg(decimal_sum("cost_inr").alias("c"))
    placed = (per_machine.join(star.dim("dim_machine", "machine_id", "plant_id"), "machine_id")
              .groupBy("plant_id").agg(F.sum("c").alias("c")))
    return (placed.join(star.dim("dim_plant", "plant_id", "plant_name"), "plant_id")
            .groupBy("plant_name").agg(F.sum("c").cast("double").alias("cost_inr"))
            .orderBy(F.desc("cost_inr"), "plant_name"))


def top_maintenance_events(mdf: DataFrame, star: Star, k: int = 20) -> DataFrame:
    """The k costliest events (tie → maintenance_id); names are looked up for those only."""
    first = mdf.orderBy(F.desc("cost_inr"), "maintenance_id").limit(k)
    named = (first.join(star.dim("dim_machine", "machine_id", "machine_name", "plant_id"), "machine_id")
             .join(star.dim("dim_plant", "plant_id", "plant_name"), "plant_id"))
    return named.select("maintenance_id", "machine_name", "plant_name", "maintenance_type", "duration_minutes",
                        "cost_inr", "technician_team").orderBy(F.desc("cost_inr"), "maintenance_id")


def overall_failure_rate(df: DataFrame) -> DataFrame:
    """Rows and mean(failure_event) · 100."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  (safe_divide(F.sum("failure_event").cast("double"), F.count("failure_event")) * 100.0)
                  .alias("failure_rate_pct"))


__all__ = ["filtered_production", "filtered_maintenance", "kpi_summary", "weekly_production",
           "production_by_category", "defect_rate_by_plant", "energy_by_machine_name",
           "downtime_by_machine_type", "peak_energy_machine", "cost_by_maintenance_type",
           "maintenance_cost_by_plant", "top_maintenance_events", "overall_failure_rate"]
