"""The six analytical SQL queries.

Sums are exact decimal sums (see ``functions.scalar.exact_sum``), rounded
as decimals half away from zero, then returned as doubles. Every ordered
LIMIT carries the group key as a tie-break, so the top-k is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions.scalar import SHIFT_MINUTES, decimal_sum as _dsum, safe_divide
from shiftline.operators.aggregate import aggregate_by_attributes, grouped_through
from shiftline.operators.star import Star

def _round_dec(c, digits) -> F.Column:
    return F.round(F.col(c), digits).cast("double")


def top_energy_machines(star: Star, k: int = 10) -> DataFrame:
    """Q1: total energy per machine (via the machine's plant), top k."""
    per_machine = star.fact_production.groupBy("machine_id").agg(_dsum("energy_consumed_kwh").alias("e"))
    j = (per_machine.join(star.dim("dim_machine", "machine_id", "machine_name", "plant_id"), "machine_id")
         .join(star.dim("dim_plant", "plant_id", "plant_name"), "plant_id"))
    out = j.select("machine_id", "machine_name", "plant_name",
                   _round_dec("e", 1).alias("total_energy_kwh"))
    return out.orderBy(F.desc("total_energy_kwh"), F.asc("machine_id")).limit(k)


def monthly_production_by_plant(star: Star) -> DataFrame:
    """Q2: produced units by plant (fact's own plant_id), year, month."""
    out = aggregate_by_attributes(star, star.fact_production, ["plant_name", "year", "month"],
                                  {"s": _dsum("produced_qty")})
    return (out.select("plant_name", "year", "month", _round_dec("s", 0).alias("total_produced"))
            .orderBy("plant_name", "year", "month"))


def oee_by_machine(star: Star, k: int = 10) -> DataFrame:
    """Q3: mean availability × mean quality per machine, lowest k.

    Availability is averaged per row (1 − downtime/480); its mean is
    1 − Σdowntime/(480·n), taken from an exact sum. Quality averages
    1 − defective/produced over rows with produced ≠ 0 only.
    """
    ratio = 1.0 - safe_divide(F.col("defective_qty").cast("double"), F.col("produced_qty"))
    partials = {
        "n": F.count(F.lit(1)),
        "s_down": _dsum("downtime_minutes"),
        "n_down": F.count("downtime_minutes"),
        "s_q": _dsum(ratio),
        "n_q": F.count(ratio),
    }
    g = grouped_through(star.fact_production, "machine_id", star.dim_machine, ["machine_id", "machine_name"],
                        [], partials, dim_is_small=_small(star, "dim_machine"))
    avail = 1.0 - safe_divide(F.col("s_down").cast("double"), F.col("n_down")) / SHIFT_MINUTES
    qual = safe_divide(F.col("s_q").cast("double"), F.col("n_q"))
    out = g.select("machine_id", "machine_name",
                   F.round(avail, 3).alias("avg_availability"),
                   F.round(qual, 3).alias("avg_quality"),
                   F.round(avail * qual, 3).alias("oee_proxy"))
    return out.orderBy(F.asc_nulls_first("oee_proxy"), F.asc("machine_id")).limit(k)


def maintenance_cost_by_plant_type(star: Star) -> DataFrame:
    """Q4: events, total cost and mean duration by (machine's) plant and type."""
    partials = {"n_events": F.count(F.lit(1)), "s_cost": _dsum("cost_inr"),
                "s_dur": _dsum("duration_minutes"), "n_dur": F.count("duration_minutes")}
    machines = star.dim_machine.select("machine_id", "plant_id")
    g = grouped_through(star.fact_maintenance, "machine_id", machines, ["plant_id"],
                        ["maintenance_type"], partials, dim_is_small=_small(star, "dim_machine"))
    g = g.join(star.dim("dim_plant", "plant_id", "plant_name"), "plant_id")
    g = g.groupBy("plant_name", "maintenance_type").agg(*[F.sum(c).alias(c) for c in partials])
    out = g.select("plant_name", "maintenance_type", F.col("n_events").cast("bigint").alias("n_events"),
                   _round_dec("s_cost", 0).alias("total_cost_inr"),
                   F.round(safe_divide(F.col("s_dur").cast("double"), F.col("n_dur")), 0)
                   .alias("avg_duration_minutes"))
    return out.orderBy(F.desc("total_cost_inr"), "plant_name", "maintenance_type")


def failure_rate_by_machine_type(star: Star) -> DataFrame:
    """Q5: shifts, failure shifts and failure rate % by machine type."""
    partials = {"total_shifts": F.count(F.lit(1)), "failure_shifts": F.sum("failure_event")}
    g = grouped_through(star.fact_production, "machine_id", star.dim_machine, ["machine_type"], [],
                        partials, dim_is_small=_small(star, "dim_machine"))
    g = g.groupBy("machine_type").agg(*[F.sum(c).alias(c) for c in partials])
    rate = safe_divide(100.0 * F.col("failure_shifts").cast("double"), F.col("total_shifts"))
    out = g.select("machine_type", F.col("total_shifts").cast("bigint").alias("total_shifts"),
                   F.col("failure_shifts").cast("bigint").alias("failure_shifts"),
                   F.round(rate, 2).alias("failure_rate_pct"))
    return out.orderBy(F.desc("failure_rate_pct"), "machine_type")


def monthly_units_by_category(star: Star) -> DataFrame:
    """Q6: produced units by product category, year, month (a plain GROUP BY)."""
    f = (star.fact_production.select("product_id", "date_id", "produced_qty")
         .join(star.dim("dim_date", "date_id", "year", "month"), "date_id"))
    g = grouped_through(f, "product_id", star.dim_product, ["category"], ["year", "month"],
                        {"s": _dsum("produced_qty")}, dim_is_small=_small(star, "dim_product"))
    g = g.groupBy("category", "year", "month").agg(F.sum("s").alias("s"))
    return (g.select("category", "year", "month", _round_dec("s", 0).alias("total_units_produced"))
            .orderBy("category", "year", "month"))


def _small(star: Star, name: str) -> bool:
    return star.is_small(name)
