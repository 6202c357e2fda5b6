"""Scalar column helpers.

Everything here composes built-in ``pyspark.sql.functions`` so it stays
inside whole-stage codegen; no Python UDFs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "col_", "safe_divide", "present", "exact_sum", "decimal_sum", "exact_avg", "round_to", "round_half_even_int",
    "date_key", "key_to_date", "day_name", "weekend_flag", "week_start", "week_label",
    "padded_id", "clamp", "age_years", "is_valid_number", "to_flag", "SHIFT_MINUTES",
]

# Length of one shift in minutes; availability is 1 - downtime / SHIFT_MINUTES.
SHIFT_MINUTES = 480.0

# Doubles are summed as decimals of this type: 18 decimals, 20 digits before
# the point. A value that does not fit raises (ANSI cast); none is rounded
# to the scale of its source column.
MEASURE_DEC = T.DecimalType(38, 18)


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(num, den, alternate=None) -> Column:
    """DIVIDE(num, den, alternate): null (or ``alternate``) when den is 0/null.

    ANSI mode raises on x/0, so division by a possibly-zero value always
    goes through ``try_divide``.
    """
    q = F.try_divide(col_(num), col_(den))
    return q if alternate is None else F.coalesce(q, F.lit(alternate))


def present(c) -> Column:
    """The value, or null where it is NaN: a missing value in either form."""
    v = col_(c)
    return F.when(~F.isnan(v.cast("double")), v)


def decimal_sum(c) -> Column:
    """Exact partial sum of a double measure (decimal; sums again exactly)."""
    return F.sum(present(c).cast(MEASURE_DEC))


def exact_sum(c) -> Column:
    """Sum of a double measure, computed in decimal and returned as double.

    A double sum depends on the order partial sums arrive in, so it can
    differ in the last bits between runs and partitionings; the decimal
    sum is exact and reproducible. Use for totals that are reported.
    """
    return decimal_sum(c).cast("double")


def exact_avg(c) -> Column:
    """Mean of the values that are present from an exact sum; null for an empty group."""
    return safe_divide(exact_sum(c), F.count(present(c)))


def round_to(c, digits: int, *, exact_scale: int | None = None) -> Column:
    """SQL ROUND (half away from zero). When ``exact_scale`` is given the value
    is first taken as a decimal of that scale, so ties are decided on the
    decimal value, not on its binary approximation."""
    v = col_(c)
    if exact_scale is not None:
        v = v.cast(T.DecimalType(38, exact_scale))
        return F.round(v, digits).cast("double")
    return F.round(v, digits)


def round_half_even_int(c) -> Column:
    """Round half to even, then integer (pandas ``round().astype(int)``)."""
    return F.bround(col_(c), 0).cast("int")


def date_key(d) -> Column:
    """``yyyyMMdd`` text key of a date."""
    return F.date_format(col_(d), "yyyyMMdd")


def key_to_date(k) -> Column:
    return F.to_date(col_(k), "yyyyMMdd")


def day_name(d) -> Column:
    return F.date_format(col_(d), "EEEE")


def weekend_flag(d) -> Column:
    """1 on Saturday/Sunday, else 0."""
    return (F.weekday(col_(d)) >= 5).cast("int")


def week_start(d) -> Column:
    """Monday of the ISO week holding ``d``."""
    return F.to_date(F.date_trunc("week", col_(d)))


def week_label(d) -> Column:
    """Monday–Sunday period label ``yyyy-MM-dd/yyyy-MM-dd``."""
    ws = week_start(d)
    return F.concat(F.date_format(ws, "yyyy-MM-dd"), F.lit("/"),
                    F.date_format(F.date_add(ws, 6), "yyyy-MM-dd"))


def padded_id(prefix: str, n, width: int) -> Column:
    """``prefix`` + zero-padded integer, e.g. ``M%03d``."""
    return F.concat(F.lit(prefix), F.lpad(col_(n).cast("string"), width, "0"))


def clamp(c, lo=None, hi=None) -> Column:
    v = col_(c)
    if lo is not None:
        v = F.greatest(v, F.lit(lo))
    if hi is not None:
        v = F.least(v, F.lit(hi))
    return v


def age_years(as_of, d) -> Column:
    """Age in years of date ``d`` at date ``as_of`` (days / 365.25)."""
    return F.datediff(col_(as_of), col_(d)) / F.lit(365.25)


def is_valid_number(c) -> Column:
    """Not null and not NaN. Spark orders NaN above every number, so
    ``NaN >= 0`` is true; pandas compares NaN as false. Bounds checks must
    reject NaN explicitly."""
    v = col_(c)
    return v.isNotNull() & ~F.isnan(v.cast("double"))


def to_flag(c) -> Column:
    """Boolean-ish text or number to 0/1 int (True/False, true/false, 1/0)."""
    v = col_(c).cast("string")
    low = F.lower(F.trim(v))
    return (F.when(low.isin("true", "t", "yes", "1", "1.0"), 1)
            .when(low.isin("false", "f", "no", "0", "0.0"), 0)
            .otherwise(F.lit(None)).cast("int"))
