"""The star schema as one object, its joins (J1–J9) and filters.

Dimensions are joined to facts by key, without hints: the planner broadcasts
a side by its size in bytes and AQE by the size it turns out to have.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.operators import cleaning
from shiftline.operators.joins import plan_broadcasts
from shiftline.schemas import PRIMARY_KEYS

DIMS = ["dim_plant", "dim_machine", "dim_shift", "dim_product", "dim_date"]
FACTS = ["fact_production", "fact_maintenance"]
#: Column of a stored fact's month folders: yyyyMM.
MONTH = "month_id"


def month_of(date_id: str) -> Column:
    return F.substring(F.col(date_id), 1, 6)


@dataclass
class Star:
    dim_plant: DataFrame
    dim_machine: DataFrame
    dim_shift: DataFrame
    dim_product: DataFrame
    dim_date: DataFrame
    fact_production: DataFrame
    fact_maintenance: DataFrame
    #: Stored facts with their month folders, where there are any.
    parts: dict[str, DataFrame] = field(default_factory=dict)

    # ------------------------------------------------------------------ tables
    def tables(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in DIMS + FACTS}

    def dims(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n) for n in DIMS}

    def is_small(self, name: str) -> bool:
        """Whether the planner would broadcast dimension ``name`` (by bytes; runs no job)."""
        return plan_broadcasts(getattr(self, name))

    def dim(self, name: str, *cols: str) -> DataFrame:
        """Dimension, optionally projected."""
        d = getattr(self, name)
        return d.select(*cols) if cols else d

    # ------------------------------------------------------------------ filters on the calendar
    def in_calendar(self, name: str, condition: Column) -> DataFrame:
        """Rows of fact ``name`` on the days of ``dim_date`` that satisfy ``condition``.

        The days are joined on month and day, so the month folders of a stored
        fact are pruned at run time by the days found (dynamic partition pruning).
        """
        days, columns = self.dim_date.where(condition), getattr(self, name).columns
        if name not in self.parts:
            return getattr(self, name).join(days.select("date_id"), "date_id", "left_semi").select(*columns)
        return self.parts[name].join(days.select(month_of("date_id").alias(MONTH), "date_id"),
                                     [MONTH, "date_id"], "left_semi").select(*columns)

    def between(self, name: str, lo: _dt.date, hi: _dt.date) -> DataFrame:
        """Rows of fact ``name`` from day lo to day hi; other month folders are not listed for the scan."""
        days = F.col("date_id").between(lo.strftime("%Y%m%d"), hi.strftime("%Y%m%d"))
        if name not in self.parts:
            return getattr(self, name).where(days)
        return self.parts[name].where(days & F.col(MONTH).between(lo.strftime("%Y%m"), hi.strftime("%Y%m"))).drop(MONTH)

    # ------------------------------------------------------------------ joins
    def wide_production(self) -> DataFrame:
        """The fact with plant, machine, date, product and shift attributes."""
        f = self.fact_production
        f = f.join(self.dim("dim_plant", "plant_id", "plant_name", "city"), "plant_id")
        f = f.join(self.dim("dim_machine", "machine_id", "machine_name", "machine_type"), "machine_id")
        f = f.join(self.dim("dim_date", "date_id", "date", "year", "month", "day_of_week",
                            "is_weekend"), "date_id")
        f = f.join(self.dim("dim_product", "product_id", "product_name", "category"), "product_id")
        f = f.join(self.dim("dim_shift", "shift_id", "shift_name"), "shift_id")
        return f

    def maintenance_wide(self) -> DataFrame:
        """Maintenance with machine name and the machine's plant."""
        m = self.fact_maintenance.join(self.dim("dim_machine", "machine_id", "machine_name", "plant_id"),
                                       "machine_id")
        return m.join(self.dim("dim_plant", "plant_id", "plant_name"), "plant_id")


# attribute -> (dimension, join key)
ATTR_SOURCE = {
    "plant_name": ("dim_plant", "plant_id"), "city": ("dim_plant", "plant_id"),
    "state": ("dim_plant", "plant_id"), "plant_type": ("dim_plant", "plant_id"),
    "machine_name": ("dim_machine", "machine_id"), "machine_type": ("dim_machine", "machine_id"),
    "install_date": ("dim_machine", "machine_id"),
    "rated_capacity_units_per_hour": ("dim_machine", "machine_id"),
    "base_energy_kwh_per_hour": ("dim_machine", "machine_id"),
    "date": ("dim_date", "date_id"), "year": ("dim_date", "date_id"),
    "quarter": ("dim_date", "date_id"), "month": ("dim_date", "date_id"),
    "day": ("dim_date", "date_id"), "day_of_week": ("dim_date", "date_id"),
    "is_weekend": ("dim_date", "date_id"),
    "product_name": ("dim_product", "product_id"), "category": ("dim_product", "product_id"),
    "uom": ("dim_product", "product_id"),
    "shift_name": ("dim_shift", "shift_id"),
}


def attach_attrs(star: Star, f: DataFrame, attrs) -> DataFrame:
    by_dim: dict[tuple[str, str], list[str]] = {}
    for a in attrs:
        d, k = ATTR_SOURCE[a]
        by_dim.setdefault((d, k), []).append(a)
    for (d, k), cols in by_dim.items():
        f = f.join(star.dim(d, k, *cols), k)
    return f


def clean_dims(raw, dim_order: dict[str, list[str]] | None = None) -> dict[str, DataFrame]:
    """C1 + C2 on all five dimensions (lazy)."""
    dim_order = dim_order or {}
    dims = {n: cleaning.clean_dim(getattr(raw, n), PRIMARY_KEYS[n], dim_order.get(n)) for n in DIMS}
    return cleaning.conform_dims(dims)


def build_star(raw, dim_order: dict[str, list[str]] | None = None) -> Star:
    """Clean a raw star (C1–C7): dedupe dims, then validate both facts."""
    dims = clean_dims(raw, dim_order)
    return Star(**dims, fact_production=cleaning.clean_production(raw.raw_production, dims),
                fact_maintenance=cleaning.clean_maintenance(raw.raw_maintenance, dims))


# --------------------------------------------------------------------------- F1–F6
def filter_fact(df: DataFrame, plants=None, machine_types=None, start=None, end=None,
                date_col: str = "date") -> DataFrame:
    """plant-name IN, machine-type IN, inclusive date range.

    ``None`` means "no restriction" (the dashboard's default of all values /
    the full range). An empty list selects nothing, as an empty multiselect
    does. The predicates are plain column comparisons, so Catalyst pushes
    them through the joins to the dimension scans.
    """
    cond: Column = F.lit(True)
    if plants is not None:
        cond = cond & F.col("plant_name").isin(list(plants))
    if machine_types is not None:
        cond = cond & F.col("machine_type").isin(list(machine_types))
    lo, hi = date_bounds(start, end)
    if lo is not None:
        cond = cond & (F.col(date_col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(date_col) <= F.lit(hi))
    return df.where(cond)


def date_bounds(start, end):
    """a range needs both ends; with fewer than two bounds the full range applies."""
    if start is None or end is None:
        return None, None
    to = lambda v: v if isinstance(v, _dt.date) else _dt.date.fromisoformat(str(v))
    return to(start), to(end)


def filter_choices(star: Star, fact: DataFrame) -> DataFrame:
    """one row per selectable value (kind, value), plus min/max dates.

    The fact is read once: a GROUPING SETS aggregate over its three foreign
    keys gives the keys in use, and each key set then meets its dimension.
    Sorted by (kind, value).
    """
    kinds = {"plant_name": ("dim_plant", "plant_id"), "machine_type": ("dim_machine", "machine_id"),
             "date": ("dim_date", "date_id")}
    keys = [F.col(k) for _, k in kinds.values()]
    used = fact.groupingSets([[k] for k in keys], *keys).agg(F.grouping_id().alias("g"))
    # The grouping id has a bit for every key left out of a row's set.
    ids = {attr: 7 - (4 >> at) for at, attr in enumerate(kinds)}
    own = used.select("g", F.coalesce(*keys).alias("key"))
    named = None
    for attr, (dim, key) in kinds.items():
        d = star.dim(dim, key, attr).select(F.lit(ids[attr]).cast("bigint").alias("g"), F.col(key).alias("key"),
                                            F.lit(attr).alias("kind"), F.col(attr).cast("string").alias("value"))
        named = d if named is None else named.unionByName(d)
    values = own.join(named, ["g", "key"])
    days = F.col("kind") == "date"
    found = values.groupBy("kind", F.when(~days, F.col("value")).alias("value")).agg(
        F.min("value").alias("lo"), F.max("value").alias("hi"))
    ends = F.array(F.struct(F.lit("date_min").alias("kind"), F.col("lo").alias("value")),
                   F.struct(F.lit("date_max").alias("kind"), F.col("hi").alias("value")))
    one = F.array(F.struct("kind", "value"))
    return found.select(F.inline(F.when(days, ends).otherwise(one))).orderBy("kind", "value")
