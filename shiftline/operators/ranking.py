"""Distributed ordering primitives: exact positions and exact stratified
splits, without a single-partition window.

``row_number()`` over a whole table (or over a two-valued label) runs in
one task. Here rows are ordered by a hex digest; the first hex digits form
a bucket, a per-bucket count table (bounded by 16^digits per group, not by
the data) gives each bucket's starting offset, and rows are only ranked
inside their bucket. Digests are uniform, so buckets stay small even when a
group holds most of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKET_HEX_DIGITS = 4          # 65,536 buckets per group


def digest(seed, *cols) -> Column:
    """Uniform, reproducible sort key: md5 of the seed and the given columns."""
    parts = [F.lit(str(seed))] + [F.col(c).cast("string") if isinstance(c, str) else c for c in cols]
    return F.md5(F.concat_ws("|", *parts))


def positions(df: DataFrame, key: str, groups: list[str], out: str = "pos",
              digits: int = BUCKET_HEX_DIGITS) -> DataFrame:
    """1-based position of each row within ``groups`` when ordered by ``key``
    (a digest column, hex or the bytes of one; ties broken by nothing else, so keys must be unique)."""
    b = F.substring(F.hex(key) if dict(df.dtypes)[key] == "binary" else F.col(key), 1, digits)
    x = df.withColumn("_b", b)
    counts = x.groupBy(*groups, "_b").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*groups).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, "_b", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    ranked = x.join(offsets, [*groups, "_b"])
    inner = F.row_number().over(Window.partitionBy(*groups, "_b").orderBy(key))
    return ranked.withColumn(out, F.col("_off") + inner).drop("_b", "_off")


def exact_split(df: DataFrame, label: str, key: Column, bucket: Column, test_percent: int = 20,
                out: str = "is_test", latest: bool = False, keys: DataFrame | None = None) -> DataFrame:
    """Exact per-class hold-out by an order key: in each label class the
    ``ceil(n·pct/100)`` rows first in ``key`` order (last, with ``latest``)
    get ``out`` = 1. Keys must be unique in a class.

    ``bucket`` must be an order-preserving prefix of ``key`` (a coarser
    key). Counts per (class, bucket) — bounded by the bucket domain — tell
    the bucket that holds the last held-out key; only that bucket's keys are
    ranked. Both steps read the key columns alone. Every row is then compared
    with its class's threshold, one row for each class, so the wide rows are
    read once and not shuffled. ``keys`` may give the same rows' labels and
    key columns from a plainer source than ``df``, such as the stored fact
    under a plan with windows; the counts and the bucket are then read there.
    """
    # A row without a label has no class to be split in; joins would drop it silently.
    labelled = F.coalesce(F.col(label), F.raise_error(F.lit(f"{label} is null: reject such rows first"))
                          .cast(df.schema[label].dataType))
    x = df.withColumn(label, labelled).withColumn("_key", key)
    narrow = (x if keys is None else keys.withColumn("_key", key)).select(label, "_key", bucket.alias("_b"))
    counts = narrow.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_n"))
    order_b = F.desc("_b") if latest else F.asc("_b")
    w_cls = Window.partitionBy(label)
    k = F.ceil(F.sum("_n").over(w_cls) * float(test_percent) / 100.0)
    cum = F.sum("_n").over(w_cls.orderBy(order_b).rowsBetween(Window.unboundedPreceding, 0))
    edge = counts.select(label, "_b", (cum - F.col("_n")).alias("_before"), cum.alias("_cum"), k.alias("_k")).where(
        (F.col("_before") < F.col("_k")) & (F.col("_cum") >= F.col("_k"))).select(
        label, "_b", (F.col("_k") - F.col("_before")).alias("_room"))          # one row per class
    order_k = F.desc("_key") if latest else F.asc("_key")
    rank = F.row_number().over(Window.partitionBy(label, "_b").orderBy(order_k))
    last = (narrow.join(F.broadcast(edge), [label, "_b"]).withColumn("_r", rank)
            .where(F.col("_r") == F.col("_room")).select(label, F.col("_key").alias("_last")))
    held = (F.col("_key") >= F.col("_last")) if latest else (F.col("_key") <= F.col("_last"))
    return (x.join(F.broadcast(last), label, "left")
            .withColumn(out, F.coalesce(held, F.lit(False)).cast("int")).drop("_key", "_last"))


def stratified_split(df: DataFrame, label: str, key_cols: list[str], test_percent: int = 20,
                     seed: int = 42, out: str = "is_test",
                     digits: int = BUCKET_HEX_DIGITS, keys: DataFrame | None = None) -> DataFrame:
    """Exact stratified random hold-out: in each label class, the
    ``ceil(n·pct/100)`` rows with the smallest digest(seed, keys) are test
    rows (``out`` = 1). Digest prefixes are the buckets."""
    key = digest(seed, *key_cols)
    return exact_split(df, label, key, F.substring(key, 1, digits), test_percent, out, keys=keys)


def time_split(df: DataFrame, label: str, time_cols: list[str], test_percent: int = 20,
               out: str = "is_test", bucket_chars: int = 11, keys: DataFrame | None = None) -> DataFrame:
    """Exact stratified *time-ordered* hold-out: the latest
    ``ceil(n·pct/100)`` rows of each class (ordered by the concatenated,
    fixed-width ``time_cols``, e.g. date_id, shift_id, machine_id) are test
    rows, so no test row precedes a training row of its class in time.
    Buckets are the first ``bucket_chars`` characters (yyyyMMdd|S1: a shift of a day)."""
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in time_cols])
    return exact_split(df, label, key, F.substring(key, 1, bucket_chars), test_percent, out, latest=True, keys=keys)
