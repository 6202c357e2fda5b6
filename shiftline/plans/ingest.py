"""Ingest reports: rejects, constraints and table counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from shiftline.operators import cleaning
from shiftline.operators.star import DIMS, Star
from shiftline.schemas import PRIMARY_KEYS


def reject_report(raw, star: Star) -> DataFrame:
    """(table_name, status, n_rows) — kept rows and every reject reason,
    for the five raw dimensions and both raw facts. Kept + rejected = input."""
    parts = [cleaning.dim_reject_counts(getattr(raw, d), PRIMARY_KEYS[d], d) for d in DIMS]
    dims = star.dims()
    parts.append(cleaning.fact_reject_counts(
        cleaning.flag_production(raw.raw_production, dims, getattr(raw, "slot_order", None)), "fact_production"))
    parts.append(cleaning.fact_reject_counts(cleaning.flag_maintenance(raw.raw_maintenance, dims),
                                             "fact_maintenance"))
    return reduce(DataFrame.unionByName, parts)


def constraint_report(star: Star) -> DataFrame:
    """C9 over the loaded tables (PK, NOT NULL, FK incl. machine→plant)."""
    return cleaning.constraint_report(star.tables())


def table_counts(star: Star) -> DataFrame:
    """Post-load row counts."""
    return cleaning.table_counts(star.tables())
