"""Per-machine history features.

A window partitioned by machine would put a machine's whole history in one
sorted task, and one machine may hold a third of all rows. So the unit of
parallelism is (machine, day):

* rows are windowed within their (machine, day) — a handful of shifts;
* a day-level table (one row per machine-day, so at most one row per
  calendar day per machine — bounded by the calendar, not by data volume)
  carries whatever crosses day boundaries: the last rows of earlier days,
  running counts, reset positions;
* that table is joined back on (machine, day).

The fact is shuffled at full width once, by (machine, day); the W2/W3 day
tails take a second, narrow shuffle (at most n rows per machine-day, cut
map-side by a partial top-n), and W5 reads its rows branch twice from one
shared shuffle. NaN counts as missing, as null does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.functions.scalar import present, safe_divide


def _day_window(entity, day, order):
    return Window.partitionBy(entity, day).orderBy(*order)


def prior_features(df: DataFrame, entity: str = "machine_id", day: str = "date_id",
                   order: tuple[str, ...] = ("shift_id", "record_id"), n_prior: int = 3,
                   avg_col: str = "downtime_minutes", lag_col: str = "machine_wear_index",
                   avg_name: str = "prior_downtime_avg3", lag_name: str = "prior_wear",
                   attach: tuple[tuple[DataFrame, str], ...] = ()) -> DataFrame:
    """In (entity, day, *order) sequence,

    * ``avg_name`` = mean of the previous ``n_prior`` rows' ``avg_col``
      (current row excluded, missing values skipped, 0 when there is none);
    * ``lag_name`` = the previous row's ``lag_col``, or the current row's
      own value on the first row (and when the previous value is missing).

    The few values of a mean are added in sequence order as doubles.

    ``attach`` lists dimensions keyed by the entity or the day. They are joined
    (inner) to the day-level table, which has a row for each entity and day and
    is joined to the rows anyway, so a dimension that is too large to broadcast
    costs no further shuffle of the rows.
    """
    rec = F.struct(present(avg_col).alias("a"), present(lag_col).alias("w"))
    w_day = _day_window(entity, day, order)
    rows = df.withColumn("_same", F.collect_list(rec).over(w_day.rowsBetween(-n_prior, -1)))

    # last n_prior rows of each (entity, day), in order
    tail_rank = F.row_number().over(Window.partitionBy(entity, day).orderBy(*[F.desc(c) for c in order]))
    tails = (df.select(entity, day, *order, rec.alias("_r"), tail_rank.alias("_k"))
             .where(F.col("_k") <= n_prior)
             .groupBy(entity, day)
             .agg(F.sort_array(F.collect_list(F.struct(*[F.col(c) for c in order], F.col("_r"))))
                  .alias("_t")))
    tails = tails.select(entity, day, F.transform("_t", lambda x: x["_r"]).alias("_tail"))

    # rows from the previous n_prior non-empty days cover the previous n_prior rows
    w_ent = Window.partitionBy(entity).orderBy(day).rowsBetween(-n_prior, -1)
    halo = tails.select(entity, day, F.flatten(F.collect_list("_tail").over(w_ent)).alias("_halo"))

    for dim, key in attach:
        halo = halo.join(dim, key)
    out = rows.join(halo, [entity, day], "inner" if attach else "left")
    empty = F.filter(F.col("_same"), lambda x: F.lit(False))      # typed empty array
    hist = F.concat(F.coalesce(F.col("_halo"), empty), F.col("_same"))
    start = F.greatest(F.size(hist) - (n_prior - 1), F.lit(1))
    prev = F.slice(hist, start, F.lit(n_prior))
    vals = F.filter(F.transform(prev, lambda x: x["a"]), lambda v: v.isNotNull())
    total = F.aggregate(vals, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    mean = F.coalesce(safe_divide(total, F.size(vals)), F.lit(0.0))
    last = F.try_element_at(hist, F.lit(-1))
    return (out.withColumn(avg_name, mean)
            .withColumn(lag_name, F.coalesce(last["w"], F.col(lag_col)))
            .drop("_same", "_halo"))


def defect_rate_row(df: DataFrame) -> DataFrame:
    """Defective / produced per row; 0 when produced is 0 or missing."""
    return df.withColumn("defect_rate", F.coalesce(
        safe_divide(F.col("defective_qty").cast("double"), F.col("produced_qty")), F.lit(0.0)))


def wear_cycles(prod: DataFrame, maint: DataFrame, entity: str = "machine_id", day: str = "date_id",
                order: tuple[str, ...] = ("shift_id", "record_id")) -> DataFrame:
    """Service cycles of each machine ("wear accumulates, resets at service").

    A reset happens after a failed shift (effective from the next shift)
    and after a day with a preventive maintenance event (effective from the
    next day). ``cycle_id`` = resets before the row (failed shifts plus
    preventive days); ``shifts_in_cycle`` = 1-based position in the cycle.
    """
    w_day = _day_window(entity, day, order)
    fail = F.col("failure_event") == 1
    rows = (prod.select(entity, day, *order, "failure_event")
            .withColumn("_rn", F.row_number().over(w_day))
            .withColumn("_fails_before_in_day",
                        F.coalesce(F.sum(fail.cast("int")).over(
                            w_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .withColumn("_last_fail_rn_in_day",
                        F.max(F.when(fail, F.col("_rn"))).over(
                            w_day.rowsBetween(Window.unboundedPreceding, -1))))

    # Both sides of a day, as one table by entity: the rows are counted where they are, and one
    # narrow shuffle by entity then serves the sums by day and the running sums.
    made = rows.groupBy(entity, day).agg(
        F.count(F.lit(1)).alias("_n"), F.sum(fail.cast("int")).alias("_fails"),
        F.max(F.when(fail, F.col("_rn"))).alias("_last_fail_rn"), F.lit(0).alias("_prev"))
    served = (maint.where(F.col("maintenance_type") == "Preventive").select(entity, day).distinct()
              .select(entity, day, F.lit(0).cast("long").alias("_n"), F.lit(0).cast("long").alias("_fails"),
                      F.lit(None).cast("int").alias("_last_fail_rn"), F.lit(1).alias("_prev")))
    days = made.unionByName(served).repartition(F.col(entity)).groupBy(entity, day).agg(
        F.sum("_n").alias("_n"), F.coalesce(F.sum("_fails"), F.lit(0)).alias("_fails"),
        F.max("_last_fail_rn").alias("_last_fail_rn"), F.max("_prev").alias("_prev"))

    w_before = Window.partitionBy(entity).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    days = (days.withColumn("_rows_before", F.coalesce(F.sum("_n").over(w_before), F.lit(0)))
            .withColumn("_fails_before", F.coalesce(F.sum("_fails").over(w_before), F.lit(0)))
            .withColumn("_prev_before", F.coalesce(F.sum("_prev").over(w_before), F.lit(0))))
    # first row index of the cycle that starts after this day's resets
    reset_start = F.greatest(
        F.when(F.col("_prev") == 1, F.col("_rows_before") + F.col("_n") + 1),
        F.col("_rows_before") + F.col("_last_fail_rn") + 1)
    days = days.withColumn("_reset_start", reset_start).withColumn(
        "_start_before", F.coalesce(F.max("_reset_start").over(w_before), F.lit(1)))

    # every row's (entity, day) is in ``days``; a left join keeps the fact
    # scan free of inferred null filters, so both branches share one shuffle
    out = rows.join(days.select(entity, day, "_rows_before", "_fails_before", "_prev_before",
                                "_start_before"), [entity, day], "left")
    idx = F.col("_rows_before") + F.col("_rn")
    start = F.coalesce(F.col("_rows_before") + F.col("_last_fail_rn_in_day") + 1, F.col("_start_before"))
    return out.select(entity, day, *order, "failure_event",
                      (F.col("_fails_before") + F.col("_fails_before_in_day") + F.col("_prev_before"))
                      .cast("bigint").alias("cycle_id"),
                      (idx - start + 1).cast("bigint").alias("shifts_in_cycle"))


# The total order of a machine's history is (date_id, shift_id, record_id);
# every function here takes it as (day, *order).
