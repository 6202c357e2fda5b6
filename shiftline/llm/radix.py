"""Distributed least-significant-digit radix sort: ranks by stable counting-sort passes.

Rows hold a place in the present order. A pass takes one digit of the key: rows
are counted by digit and block of places, prefix sums over (digit, block) give
every block its first destination for every digit, and a row goes to that
destination plus the number of rows of the same block and digit before it.
After a pass for each digit, lowest first, the places are the final ranks.

What meets in one task is one digit's rows of one block (``BLOCK`` places at
most), one digit's counts in a run of ``RUN`` blocks, or the digits' totals. A
hot digit is spread over its blocks. Each pass is written to the shared folder,
so a lost executor costs a re-read; the pass before it is dropped then.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.common import new_folder, stored
from shiftline.session import remove_folder

#: Bits of a digit, places of a block, blocks whose counts are summed together.
BITS = 11
BLOCK = 1 << 11
RUN = 1 << 10
LOWEST = -(1 << 63)


def digits_of(value: Column, down: bool, low: int | None, high: int | None, nulls: bool | None) -> list[Column]:
    """The digits, lowest first, that order values from low to high; nulls come last."""
    if low is None:
        return []
    if (high - low).bit_length() < 64:
        place = F.lit(high) - value if down else value - F.lit(low)
    else:                                  # the difference passes a long: order by the bits, sign turned
        place = F.bitwise_not(value.bitwiseXOR(F.lit(LOWEST))) if down else value.bitwiseXOR(F.lit(LOWEST))
    digit = lambda d: F.shiftrightunsigned(place, d * BITS).bitwiseAND(F.lit((1 << BITS) - 1))
    found = [F.coalesce(digit(d), F.lit(0)).cast("long") for d in range(-(-(high - low).bit_length() // BITS))]
    # Null or not is the digit that decides before all others.
    return found + [value.isNull().cast("long")] if nulls else found


def rank(rows: DataFrame, key: list[tuple[str, bool]], out: str) -> DataFrame:
    """``rows`` with ``out``: 1, 2, 3 ... by the key, and by nothing else.

    ``key`` lists (long column, whether descending), the weightiest first; nulls
    come last in either direction. Rows equal in the whole key get their ranks in any order.
    """
    spark, held = rows.sparkSession, rows.columns
    folder = new_folder(spark, "radix")
    state = stored(rows.withColumn(out, F.monotonically_increasing_id()), folder)
    ends = state.agg(*[f(F.col(c)).alias(f"{n}_{k}") for k, (c, _) in enumerate(key) for n, f in (
        ("low", F.min), ("high", F.max), ("null", lambda x: F.max(x.isNull())))]).first()
    digits = [d for k, (c, down) in reversed(list(enumerate(key)))
              for d in digits_of(F.col(c), down, ends[f"low_{k}"], ends[f"high_{k}"], ends[f"null_{k}"])]
    for digit in digits or [F.lit(0).cast("long")]:
        after = new_folder(spark, "radix")
        state = stored(_counting_pass(state, digit, held, out), after)
        remove_folder(spark, folder)
        folder = after
    return state.withColumn(out, F.col(out) + 1)


def _counting_pass(state: DataFrame, digit: Column, held: list[str], out: str) -> DataFrame:
    """One stable counting sort: ``out`` becomes the destination of each row."""
    placed = state.select(*[F.col(f"`{c}`") for c in held], out, digit.alias("_digit"),
                          F.floor(F.col(out) / BLOCK).alias("_block"))
    counts = placed.groupBy("_digit", "_block").agg(F.count(F.lit(1)).alias("_n")).withColumn(
        "_run", F.floor(F.col("_block") / RUN))
    before = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    summed = lambda c, over: F.coalesce(F.sum(c).over(over), F.lit(0))
    in_run = counts.withColumn("_in_run", summed("_n", before("_digit", "_run").orderBy("_block")))
    runs = counts.groupBy("_digit", "_run").agg(F.sum("_n").alias("_n")).withColumn(
        "_runs", summed("_n", before("_digit").orderBy("_run")))
    # One row a digit, 2**BITS at most, so this window without a partition is bounded.
    digits = counts.groupBy("_digit").agg(F.sum("_n").alias("_n")).withColumn(
        "_first", summed("_n", before().orderBy("_digit")))
    starts = in_run.join(runs.drop("_n"), ["_digit", "_run"]).join(digits.drop("_n"), "_digit").select(
        "_digit", "_block", (F.col("_first") + F.col("_runs") + F.col("_in_run")).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_digit", "_block").orderBy(out)) - 1
    return placed.withColumn("_own", own).join(starts, ["_digit", "_block"]).select(
        *[F.col(f"`{c}`") for c in held], (F.col("_start") + F.col("_own")).cast("long").alias(out))
