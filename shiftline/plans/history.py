"""Machine-history views (W1–W5), the calendar (T1) and the grain gap report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.functions.scalar import key_to_date
from shiftline.operators import calendar, windows
from shiftline.operators.star import Star

KEYS = ["machine_id", "date_id", "shift_id", "record_id"]


def machine_history(star: Star) -> DataFrame:
    """Production rows with prior_downtime_avg3, prior_wear and defect_rate."""
    return windows.defect_rate_row(windows.prior_features(star.fact_production))


def wear_cycles(star: Star) -> DataFrame:
    return windows.wear_cycles(star.fact_production, star.fact_maintenance)


def calendar_dim(star: Star) -> DataFrame:
    """T1 over the production date range (first to last day, no gaps)."""
    b = star.fact_production.agg(key_to_date(F.min("date_id")).alias("start"),
                                 key_to_date(F.max("date_id")).alias("end"))
    return calendar.calendar_dim(b)


def missing_slot_runs(star: Star) -> DataFrame:
    """J9 over the full calendar and all machines, idle ones too, as intervals."""
    return calendar.missing_slot_runs(star.fact_production, star.dim_machine, star.dim_shift)


def missing_slots(star: Star) -> DataFrame:
    return calendar.missing_slots(star.fact_production, star.dim_shift)
