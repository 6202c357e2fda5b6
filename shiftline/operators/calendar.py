"""Calendar dimension builder (T1) and the fact-grain gap report."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.functions.scalar import date_key, day_name, key_to_date, weekend_flag


def calendar_dim(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """One dim_date row per day in [start, end] for each bounds row.

    ``bounds`` is typically a one-row aggregate (min/max of the fact's
    dates); the generated table has one row per calendar day.
    """
    d = bounds.select(F.explode(F.sequence(F.col(start_col), F.col(end_col))).alias("date"))
    return d.select(date_key("date").alias("date_id"), "date",
                    F.year("date").alias("year"), F.quarter("date").alias("quarter"),
                    F.month("date").alias("month"), F.dayofmonth("date").alias("day"),
                    day_name("date").alias("day_of_week"), weekend_flag("date").alias("is_weekend"))


def calendar_from_days(start, n_days: int, spark) -> DataFrame:
    """T1 as the loader builds it: ``n_days`` consecutive days from ``start``."""
    b = spark.range(1).select(F.lit(start).cast("date").alias("start"))
    b = b.withColumn("end", F.date_add("start", n_days - 1))
    return calendar_dim(b)


def _shift_list(dim_shift: DataFrame) -> F.Column:
    """The shift ids as a sorted array: a scalar subquery over the (small,
    fixed) shift dimension, so no cartesian join is planned."""
    return dim_shift.select(F.sort_array(F.collect_set("shift_id"))).scalar()


def _active_days(prod: DataFrame, entity: str) -> DataFrame:
    """(entity, date_id) for every calendar day between each entity's first
    and last production day. One ``sequence`` per entity, bounded by the
    calendar, not by the entity's row count."""
    span = prod.groupBy(entity).agg(F.min("date_id").alias("_lo"), F.max("date_id").alias("_hi"))
    days = span.select(entity, F.explode(F.sequence(key_to_date("_lo"), key_to_date("_hi"))).alias("_d"))
    return days.select(entity, date_key("_d").alias("date_id"))


def expected_slots(prod: DataFrame, dim_shift: DataFrame, entity: str = "machine_id") -> DataFrame:
    """Every (entity, day, shift) slot between each entity's first and last production day."""
    return _active_days(prod, entity).select(entity, "date_id",
                                             F.explode(_shift_list(dim_shift)).alias("shift_id"))


def missing_slots(prod: DataFrame, dim_shift: DataFrame, entity: str = "machine_id") -> DataFrame:
    """Expected slots with no production row.

    Works at day grain: the active-day spine is left-joined to the set of
    shifts present on each (entity, day) — a set bounded by the shift
    dimension however many rows a slot has — and the missing shifts are the
    array difference. The shuffle carries one row per entity-day instead of
    one per slot.
    """
    present = prod.groupBy(entity, "date_id").agg(F.collect_set("shift_id").alias("_have"))
    days = _active_days(prod, entity).join(present, [entity, "date_id"], "left")
    have = F.coalesce(F.col("_have"), F.array().cast("array<string>"))
    return days.select(entity, "date_id",
                       F.explode(F.array_except(_shift_list(dim_shift), have)).alias("shift_id"))


def slots_of_runs(runs: DataFrame, dim_shift: DataFrame, first_day: str, last_day: str,
                  entity: str = "machine_id") -> DataFrame:
    """The single slots of ``missing_slot_runs`` from first_day to last_day (yyyyMMdd), as (entity, date_id, shift_id).

    Filter the runs by entity first: what comes out grows with entities × days × shifts.
    """
    day = lambda c: key_to_date(F.substring(c, 1, 8))
    lo = F.greatest(day("first_slot"), key_to_date(F.lit(first_day)))
    hi = F.least(day("last_slot"), key_to_date(F.lit(last_day)))
    days = runs.where(lo <= hi).select(entity, "first_slot", "last_slot", F.explode(F.sequence(lo, hi)).alias("_d"))
    slots = days.select(entity, "first_slot", "last_slot", date_key("_d").alias("date_id"),
                        F.explode(_shift_list(dim_shift)).alias("shift_id"))
    return slots.where(F.concat_ws(" ", "date_id", "shift_id").between(F.col("first_slot"), F.col("last_slot"))).select(
        entity, "date_id", "shift_id")


def missing_slot_runs(prod: DataFrame, machines: DataFrame, dim_shift: DataFrame,
                      entity: str = "machine_id") -> DataFrame:
    """J9 as intervals: every run of consecutive missing slots of each machine.

    A slot's number is day × shifts + shift, over the fact's first to last
    day. The slots in use, each once, are bounded by the calendar; a run is
    the space between two of them, or between one and an end of the calendar,
    so there are at most (slots in use + machines) rows. A machine without
    production is missing throughout. Columns: entity, first_slot,
    last_slot (date_id and shift_id joined by a blank), n_slots.
    """
    shifts = _shift_list(dim_shift)
    span = prod.agg(key_to_date(F.min("date_id")).alias("lo"), key_to_date(F.max("date_id")).alias("hi"))
    lo, hi = span.select("lo").scalar(), span.select("hi").scalar()
    n = F.size(shifts)
    number = F.datediff(key_to_date("date_id"), lo) * n + F.array_position(shifts, F.col("shift_id")) - 1
    used = prod.select(entity, number.cast("bigint").alias("at")).distinct()
    ends = machines.select(entity).distinct().select(entity, F.explode(F.array(
        F.lit(-1).cast("bigint"), ((F.datediff(hi, lo) + 1) * n).cast("bigint"))).alias("at"))
    along = Window.partitionBy(entity).orderBy("at")
    gaps = used.unionByName(ends).withColumn("next", F.lead("at").over(along)).where(F.col("next") - F.col("at") > 1)
    slot = lambda at: F.concat_ws(" ", date_key(F.date_add(lo, F.floor(at / n).cast("int"))),
                                  F.get(shifts, F.pmod(at, n).cast("int")))
    return gaps.select(entity, slot(F.col("at") + 1).alias("first_slot"), slot(F.col("next") - 1).alias("last_slot"),
                       (F.col("next") - F.col("at") - 1).alias("n_slots"))
