"""Validated ingest.

Each check is a column expression or a key lookup, so validation is one
pass over a fact: the same flagged frame yields the clean table (rows with
no reject reason) and the reject accounting (group by reason). Nothing is
collected to the driver; key sets stay DataFrames and become joins.
"""

from __future__ import annotations

import warnings
from collections.abc import Collection
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftline.functions.scalar import is_valid_number, round_half_even_int
from shiftline.operators.joins import plan_broadcasts
from shiftline.operators.keysets import may_hold
from shiftline.schemas import (FACT_MAINTENANCE, FACT_PRODUCTION, FOREIGN_KEYS, NOT_NULL,
                               PRIMARY_KEYS, TABLES)

REASON = "reject_reason"

# Reject reasons, in the order the checks are applied.
PRODUCTION_REASONS = ["orphan_plant", "orphan_machine", "orphan_shift", "orphan_product",
                      "orphan_date", "negative_produced", "negative_defective",
                      "downtime_out_of_range", "negative_energy", "missing_failure_flag"]
DUPLICATE_SLOT = "duplicate_slot"
PRODUCTION_GRAIN = ["machine_id", "date_id", "shift_id"]
MAINTENANCE_REASONS = ["orphan_machine", "orphan_date"]


# --------------------------------------------------------------------------- C1, C2
def clean_dim(df: DataFrame, key: str, order_cols: list[str] | None = None) -> DataFrame:
    """Drop null keys, then keep the first row per key.

    "First" is the smallest ``order_cols`` tuple (an ingest-order column
    when the source has one); remaining columns break ties so the survivor
    is deterministic. ``min(struct)`` has a map-side partial step, so even a
    key repeated millions of times is reduced before the shuffle (a sort
    aggregate: the buffer is a struct). Output keeps the input column order, minus
    ``order_cols`` that are not part of the input schema proper.
    """
    cols = [c for c in df.columns if c != key and c not in (order_cols or [])]
    order = list(order_cols or [])
    packed = F.struct(*[F.col(c) for c in order + cols])
    out = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(packed).alias("_first"))
    keep = [c for c in df.columns if c not in (order_cols or [])]
    return out.select(*[F.col(key) if c == key else F.col(f"_first.{c}").alias(c) for c in keep])


def dim_reject_counts(df: DataFrame, key: str, table: str) -> DataFrame:
    """(table_name, status, n_rows) for a dimension: kept / null_key / duplicate_key."""
    g = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    isnull = F.col(key).isNull()
    sums = g.agg(
        F.sum(F.when(~isnull, 1).otherwise(0)).cast("bigint").alias("kept"),
        F.sum(F.when(isnull, F.col("n")).otherwise(0)).cast("bigint").alias("null_key"),
        F.sum(F.when(~isnull, F.col("n") - 1).otherwise(0)).cast("bigint").alias("duplicate_key"),
    )
    long = sums.unpivot([], ["kept", "null_key", "duplicate_key"], "status", "n_rows")
    return (long.where(F.col("n_rows") > 0)
            .select(F.lit(table).alias("table_name"), "status", "n_rows"))


# --------------------------------------------------------------------------- C3–C8
def _flag_orphans(df: DataFrame, fks: list[tuple[str, DataFrame, str]]) -> tuple[DataFrame, list[Column]]:
    """Left-join each dimension's key set; a missing match flags an orphan.

    Dimensions must already have unique keys (``clean_dim``), so the joins
    never multiply rows. A null foreign key never matches: it is an orphan.
    The planner chooses each join by the key set's size in bytes.
    """
    missing = []
    for i, (col, dim, key) in enumerate(fks):
        flag = f"_fk{i}"
        keys = dim.select(F.col(key).alias(col), F.lit(True).alias(flag))
        df = df.join(keys, col, "left")
        missing.append(F.col(flag).isNull())
    return df, missing


def _nonneg(c: str) -> Column:
    return is_valid_number(c) & (F.col(c) >= 0)


def _first_reason(pairs: list[tuple[Column, str]]) -> Column:
    expr = None
    for cond, reason in pairs:
        expr = F.when(cond, F.lit(reason)) if expr is None else expr.when(cond, F.lit(reason))
    return expr


def _fks(table: str, dims: dict[str, DataFrame]):
    return [(c, dims[d], PRIMARY_KEYS[d]) for c, d in FOREIGN_KEYS[table]]


def later_in_slot(df: DataFrame, grain: list[str], order: list[str]) -> Column:
    """True for every row but the first of its slot, by ``order``, a total order but for equal rows.

    A slot is one machine's shift of one day, so its rows in one task stay few.
    """
    return F.row_number().over(Window.partitionBy(*grain).orderBy(*order)) > 1


def without_unknown_keys(df: DataFrame, fks: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Rows whose keys may all be known, for joins that keep only those.

    Key sets that the planner broadcasts need no filter; a larger one would
    shuffle the fact by its key, so a Bloom filter goes before that shuffle.
    """
    for col, dim, key in fks:
        if not plan_broadcasts(dim.select(key)):
            df = df.where(may_hold(dim.select(key), key, F.col(col)))
    return df


def _of_known_keys(df: DataFrame, fks: list[tuple[str, DataFrame, str]]) -> tuple[DataFrame, list]:
    """``without_unknown_keys``, and exactly by the key sets that the planner broadcasts; also the keys still to be looked up.

    A semi join with a broadcast set moves no rows, so the shuffles after it move known rows only.
    """
    later = []
    for col, dim, key in fks:
        keys = dim.select(F.col(key).alias(col))
        if plan_broadcasts(keys):
            df = df.join(keys, col, "left_semi")
        else:
            later.append((col, dim, key))
    return without_unknown_keys(df, later), later


def flag_production(raw: DataFrame, dims: dict[str, DataFrame],
                    slot_order: list[str] | None = None, only_known: bool = False) -> DataFrame:
    """Raw production rows plus ``reject_reason`` (null = valid).

    ``only_known`` leaves out rows as soon as they are certain to be invalid,
    for callers that keep the valid rows only.

    With ``slot_order`` a (machine, date, shift) slot keeps its first row by
    that order and the others are rejected as ``duplicate_slot``, so kept and
    rejected rows add up to the input.
    """
    fks = _fks("fact_production", dims)
    reasons = dict(zip([c for c, *_ in fks], PRODUCTION_REASONS))
    late, later = [], []
    if only_known:
        # A slot's rows share these keys: whole slots go, before they are shuffled, and no other row becomes the first.
        raw, later = _of_known_keys(raw, [fk for fk in fks if fk[0] in PRODUCTION_GRAIN])
    if slot_order:
        raw = raw.withColumn("_late", later_in_slot(raw, PRODUCTION_GRAIN, slot_order))
        late = [(F.col("_late"), DUPLICATE_SLOT)]
    downtime_ok = is_valid_number("downtime_minutes") & F.col("downtime_minutes").between(0, 480)
    values = [
        (~_nonneg("produced_qty"), "negative_produced"),
        (~_nonneg("defective_qty"), "negative_defective"),
        (~downtime_ok, "downtime_out_of_range"),
        (~_nonneg("energy_consumed_kwh"), "negative_energy"),
        (F.col("failure_event").isNull(), "missing_failure_flag"),
    ]
    if only_known:
        raw, fks = _of_known_keys(raw, [fk for fk in fks if fk[0] not in PRODUCTION_GRAIN])
        fks = later + fks
        raw = raw.where(_first_reason(late + values).isNull())
    df, missing = _flag_orphans(raw, fks)
    checks = late + [(m, reasons[c]) for m, (c, *_) in zip(missing, fks)] + values
    return df.withColumn(REASON, _first_reason(checks)).drop("_late", *[f"_fk{i}" for i in range(len(fks))])


def flag_maintenance(raw: DataFrame, dims: dict[str, DataFrame], only_known: bool = False) -> DataFrame:
    fks = _fks("fact_maintenance", dims)
    reasons = dict(zip([c for c, *_ in fks], MAINTENANCE_REASONS))
    if only_known:
        raw, fks = _of_known_keys(raw, fks)
    df, missing = _flag_orphans(raw, fks)
    first = _first_reason([(m, reasons[c]) for m, (c, *_) in zip(missing, fks)])
    return (df.withColumn(REASON, F.lit(None).cast("string") if first is None else first)
            .drop(*[f"_fk{i}" for i in range(len(fks))]))


def clamp_defective(df: DataFrame) -> DataFrame:
    """defective = round_half_even(min(defective, produced)) as int.

    Rounding happens after the min, so 10.6 produced with 12 defective
    keeps 11 defective (larger than produced) — the loader's behaviour.
    """
    v = F.least(F.col("defective_qty").cast("double"), F.col("produced_qty"))
    return df.withColumn("defective_qty", round_half_even_int(v))


def _conform(df: DataFrame, schema) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def clean_production(raw: DataFrame, dims: dict[str, DataFrame],
                     slot_order: list[str] | None = None) -> DataFrame:
    """C3 + C5 + C6 + C7: the loadable fact_production."""
    kept = flag_production(raw, dims, slot_order, only_known=True).where(F.col(REASON).isNull())
    return _conform(clamp_defective(kept), FACT_PRODUCTION)


def clean_maintenance(raw: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """C4: machine and date must exist; no bounds, no dedupe."""
    kept = flag_maintenance(raw, dims, only_known=True).where(F.col(REASON).isNull())
    return _conform(kept, FACT_MAINTENANCE)


def fact_reject_counts(flagged: DataFrame, table: str) -> DataFrame:
    status = F.coalesce(F.col(REASON), F.lit("kept"))
    return (flagged.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(table).alias("table_name"), "status", "n_rows"))


# --------------------------------------------------------------------------- C9
def constraint_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, check_name, n_violations) for PK uniqueness, PK and
    NOT NULL columns, and every foreign key (including machine→plant, which
    the loader never checks).

    One scan per table: each foreign key is flagged by a left join with the
    dimension's *distinct* key set (so it cannot multiply rows, even on
    uncleaned input), and a single aggregate counts every check. The
    per-table rows are unioned: one job.
    """
    parts = []
    for t, df in tables.items():
        pk = PRIMARY_KEYS[t]
        fks = [(c, d) for c, d in FOREIGN_KEYS.get(t, []) if d in tables]
        flagged = df
        for i, (col, dim) in enumerate(fks):
            keys = (tables[dim].select(F.col(PRIMARY_KEYS[dim]).alias(col)).where(F.col(col).isNotNull())
                    .distinct().withColumn(f"_fk{i}", F.lit(True)))
            flagged = flagged.join(keys, col, "left")
        aggs = [F.count(F.when(F.col(pk).isNull(), 1)).alias("pk_null"),
                (F.count(F.col(pk)) - F.count_distinct(F.col(pk))).alias("pk_duplicate")]
        aggs += [F.count(F.when(F.col(c).isNull(), 1)).alias(f"not_null:{c}") for c in NOT_NULL[t]]
        aggs += [F.count(F.when(F.col(f"_fk{i}").isNull(), 1)).alias(f"fk_orphan:{col}")
                 for i, (col, _) in enumerate(fks)]
        a = flagged.agg(*aggs)
        names = a.columns
        parts.append(a.select(*[F.col(f"`{n}`").cast("bigint").alias(n) for n in names])
                     .unpivot([], names, "check_name", "n_violations")
                     .select(F.lit(t).alias("table_name"), "check_name", "n_violations"))
    return reduce(DataFrame.unionByName, parts)


class ConstraintViolation(ValueError):
    pass


def assert_constraints(report: DataFrame, reported: Collection[tuple[str, str]] = ()) -> None:
    """Fail-fast form of C9 (the warehouse DDL aborts a load on a PK or
    NOT NULL breach): raise when any check has violations. Only the
    offending (table, check, count) rows reach the driver. Violations of the
    (table, check) pairs in ``reported`` are a warning."""
    bad = report.where(F.col("n_violations") > 0).collect()
    detail = {(r.table_name, r.check_name): f"{r.table_name}.{r.check_name}={r.n_violations}" for r in bad}
    refused = [text for check, text in detail.items() if check not in reported]
    if refused:
        raise ConstraintViolation(f"constraint violations: {', '.join(refused)}")
    if detail:
        warnings.warn(f"constraint violations in loaded tables: {', '.join(detail.values())}", stacklevel=2)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n_rows) for every table, as one union of counts."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table_name"), "n_rows")
             for t, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def conform_dims(dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    return {t: _conform(df, TABLES[t]) for t, df in dims.items()}
