"""Inline literal dimensions."""

from pyspark.sql import DataFrame, SparkSession

from shiftline.schemas import DIM_SHIFT

# The three eight-hour shifts (night shift wraps midnight).
SHIFTS = [
    ("S1", "Morning", "06:00", "14:00"),
    ("S2", "Afternoon", "14:00", "22:00"),
    ("S3", "Night", "22:00", "06:00"),
]


def dim_shift(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SHIFTS, DIM_SHIFT)
