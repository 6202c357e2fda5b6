"""The BI semantic model's measures.

Every measure is a final expression over a few *partial* aggregates (exact
decimal sums and counts). The partials re-aggregate by ``sum``, so a
measure set can be computed in one ``agg`` over any grouping, or from
partials pre-aggregated on a foreign key before a dimension lookup — with
bit-identical results either way. ``DIVIDE(a, b, 0)`` is
``coalesce(try_divide(a, b), 0)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shiftline.functions.scalar import SHIFT_MINUTES, decimal_sum as _dsum


def production_partials() -> dict[str, Column]:
    """Partial aggregates of the production measures (each sums again)."""
    return {"_units": _dsum("produced_qty"),
            "_defective": F.sum("defective_qty").cast("bigint"),
            "_down": _dsum("downtime_minutes"),
            "_n_down": F.count("downtime_minutes"),
            "_energy": _dsum("energy_consumed_kwh"),
            "_failures": F.sum("failure_event").cast("bigint"),
            "_n": F.count(F.lit(1))}


def production_finals(p: dict[str, Column]) -> dict[str, Column]:
    """D1–D12 from partials (columns or aggregate expressions)."""
    units = p["_units"].cast("double")                                        # D1
    defective = p["_defective"].cast("bigint")                                # D2
    defect_rate = F.coalesce(F.try_divide(defective, units), F.lit(0.0)) * 100.0   # D3
    down = p["_down"].cast("double")
    energy = p["_energy"].cast("double")                                      # D6
    failures = p["_failures"].cast("bigint")                                  # D8
    availability = (1.0 - F.coalesce(F.try_divide(down, p["_n"] * SHIFT_MINUTES), F.lit(0.0))) * 100.0  # D10
    quality = 100.0 - defect_rate                                             # D11
    return {
        "total_units_produced": units,
        "total_defective_units": defective,
        "defect_rate_pct": defect_rate,
        "total_downtime_hrs": down / 60.0,                                    # D4
        "avg_downtime_per_shift_min": F.try_divide(down, p["_n_down"]),       # D5
        "total_energy_kwh": energy,
        "energy_per_unit_kwh": F.coalesce(F.try_divide(energy, units), F.lit(0.0)),   # D7
        "failure_count": failures,
        "failure_rate_pct": F.coalesce(F.try_divide(failures, p["_n"]), F.lit(0.0)) * 100.0,  # D9
        "availability_pct": availability,
        "quality_pct": quality,
        "oee_proxy_pct": availability * quality / 100.0,                      # D12
    }


def maintenance_partials() -> dict[str, Column]:
    kind = F.col("maintenance_type")
    return {"_cost": _dsum("cost_inr"),
            "_preventive": _dsum(F.when(kind == "Preventive", F.col("cost_inr"))),
            "_corrective": _dsum(F.when(kind == "Corrective", F.col("cost_inr")))}


def maintenance_finals(p: dict[str, Column]) -> dict[str, Column]:
    """D13–D16 (D14/D15 are the CALCULATE-filtered totals, F7)."""
    total, prev = p["_cost"].cast("double"), p["_preventive"].cast("double")
    return {"total_maintenance_cost": total,                                   # D13
            "preventive_maintenance_cost": prev,                               # D14
            "corrective_maintenance_cost": p["_corrective"].cast("double"),   # D15
            "preventive_cost_share_pct": F.coalesce(F.try_divide(prev, total), F.lit(0.0)) * 100.0}  # D16


PRODUCTION_MEASURES = ["total_units_produced", "total_defective_units", "defect_rate_pct",
                       "total_downtime_hrs", "avg_downtime_per_shift_min", "total_energy_kwh",
                       "energy_per_unit_kwh", "failure_count", "failure_rate_pct", "availability_pct",
                       "quality_pct", "oee_proxy_pct"]
MAINTENANCE_MEASURES = ["total_maintenance_cost", "preventive_maintenance_cost",
                        "corrective_maintenance_cost", "preventive_cost_share_pct"]


def measure(name: str) -> Column:
    """One measure as a single aggregate expression (for ad-hoc ``agg``)."""
    if name in PRODUCTION_MEASURES:
        return production_finals(production_partials())[name]
    return maintenance_finals(maintenance_partials())[name]


def over_partials(finals_fn, partial_names, names=None) -> list[Column]:
    """Final measure columns computed from already-aggregated partial columns."""
    exprs = finals_fn({n: F.col(n) for n in partial_names})
    return [exprs[n].alias(n) for n in (names or list(exprs))]
