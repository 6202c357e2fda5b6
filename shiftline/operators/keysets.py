"""Bloom filters of key sets (J8): rows that cannot match are left out before a shuffle.

A key set that is too large to broadcast costs a shuffle of the fact by that
key. Its Bloom filter is a bounded array of bits, which goes to every task as
a scalar subquery, so rows with an unknown key are dropped in the scan. The
filter never drops a known key; the exact join still follows and decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a filter at least and at most (2 MB), and bits for each expected key.
LEAST, MOST, PER_KEY = 1 << 12, 1 << 24, 10
#: Assumed bytes of a key in the planner's estimate.
KEY_BYTES = 16


def bits_for(keys: DataFrame) -> int:
    """A power of two from the planner's size estimate; no job runs. Larger sets only let more rows through."""
    size = int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = max(LEAST, min(MOST, size // KEY_BYTES * PER_KEY))
    return 1 << (wanted - 1).bit_length()


def _places(key: Column, bits: int) -> list[Column]:
    """Two places of a key, from the halves of its hash."""
    h = F.xxhash64(key)
    return [x.bitwiseAND(F.lit(bits - 1)) for x in (h, F.shiftrightunsigned(h, 32))]


def _bit(place: Column) -> Column:
    """The bit of a place inside its word of 64."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))


def may_hold(keys: DataFrame, key: str, value: Column, bits: int | None = None) -> Column:
    """False only if ``value`` is null or not among ``keys[key]``; mostly false then."""
    spark, bits = keys.sparkSession, bits or bits_for(keys)
    set_ = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_places(F.col(key), bits))).alias("p")).select(
        F.shiftright("p", 6).alias("at"), _bit(F.col("p")).alias("word"))
    empty = spark.range(bits >> 6).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("word"))
    words = set_.unionByName(empty).groupBy("at").agg(F.bit_or("word").alias("word"))
    packed = words.agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w")).select(F.col("w.word").alias("w"))
    array = packed.scalar()
    tests = [F.get(array, F.shiftright(p, 6).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _places(value, bits)]
    return value.isNotNull() & tests[0] & tests[1]
