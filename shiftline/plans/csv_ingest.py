"""The CSV path end to end: faulty files written from the given tables, read back, cleaned.

The faults are derived from row keys, so they grow with the tables: missing
and repeated keys, NaN, fractional counts, text flags.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.operators import cleaning
from shiftline.operators.star import Star
from shiftline.session import scratch_path
from shiftline.sources import files, fixtures


def _through_csv(df: DataFrame, table: str, keep_order: bool) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, f"csv/{table}-{uuid.uuid4().hex}")
    files.write_csv_table(df, path)
    return files.read_csv_table(spark, path, table, keep_order=keep_order)


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + C2 on a product file: every 40th key is a missing marker, every
    7th product is listed again, later and under another name."""
    key = F.col("product_id").cast("bigint")
    listed = fixtures.raw_dim_product(spark, sf_dir)
    marked = listed.withColumn("product_id", F.when(key % 40 == 0, F.lit("n/a")).otherwise(F.col("product_id")))
    again = listed.where(key % 7 == 0).withColumn("product_name", F.concat("product_name", F.lit(" (again)")))
    read = _through_csv(marked.unionByName(again), "dim_product", True)
    return cleaning.clean_dim(read, "product_id", [files.ORDER_COL])


def _flagged(spark: SparkSession, sf_dir: str, star: Star) -> DataFrame:
    k = F.col("record_id")
    dirty = fixtures.raw_production(spark, sf_dir).withColumns({
        "downtime_minutes": F.when(k % 11 == 0, F.lit(float("nan"))).otherwise(F.col("downtime_minutes")),
        "defective_qty": F.col("defective_qty") + F.when(k % 3 == 0, 0.5).otherwise(0.0),
        "produced_qty": F.when(k % 5 == 0, F.col("defective_qty") - 0.4).otherwise(F.col("produced_qty")),
        "failure_event": F.when(k % 13 == 0, F.lit(None)).when(F.col("failure_event") == 1, "True").otherwise("False")})
    return cleaning.flag_production(_through_csv(dirty, "fact_production", False), star.dims())


def production(spark: SparkSession, sf_dir: str, star: Star) -> DataFrame:
    """C3–C7 and C10 on a production file: the loadable rows."""
    kept = cleaning.clamp_defective(_flagged(spark, sf_dir, star).where(F.col(cleaning.REASON).isNull()))
    return kept.select("record_id", "machine_id", "date_id", "shift_id", "produced_qty", "defective_qty",
                       "downtime_minutes", "failure_event")


def production_rejects(spark: SparkSession, sf_dir: str, star: Star) -> DataFrame:
    """C8 on the same file."""
    return cleaning.fact_reject_counts(_flagged(spark, sf_dir, star), "fact_production")
