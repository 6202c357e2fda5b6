"""CSV source and sink for the star tables.

Files are read with an all-text schema and typed in one projection:
pandas treats a list of markers as missing and leaves unparsable numbers
missing, while Spark's CSV reader has a single ``nullValue``. Reading text
first, mapping every marker to null and ``try_cast``-ing reproduces the
former without a second pass, and never infers a schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftline.functions.scalar import to_flag
from shiftline.schemas import CSV_TABLES, TABLES

# Text that pandas' CSV reader treats as a missing value by default.
MISSING_MARKERS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
                   "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

ORDER_COL = "_src_order"


def _text_schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in CSV_TABLES[table].fields])


def _missing_to_null(c: str) -> Column:
    return F.when(F.col(c).isin(MISSING_MARKERS), F.lit(None)).otherwise(F.col(c))


def _typed(c: str, t: T.DataType) -> Column:
    v = _missing_to_null(c)
    if isinstance(t, T.StringType):
        return v
    if isinstance(t, T.DateType):
        return F.try_to_timestamp(v).cast("date")
    if isinstance(t, T.IntegerType) and c in ("is_weekend", "failure_event"):
        return to_flag(v)
    if isinstance(t, (T.IntegerType, T.LongType)):
        # "12.0" and "1e3" are integers too; plain digits never pass through a double.
        number = v.try_cast("double")
        return F.coalesce(v.try_cast(t), F.when(number == F.floor(number), number).cast("string").try_cast(
            "decimal(38,0)").try_cast(t))
    return v.try_cast(t)


def read_csv_table(spark: SparkSession, path: str, table: str, keep_order: bool = True) -> DataFrame:
    """Read one star table from CSV and type it to the warehouse schema.

    All columns are read as text — no inference — and typed by name, so files
    may list the columns in any order; a missing column is an error. A CSV
    schema goes by position, so every file is checked against the header that
    is used for all of them: with ``enforceSchema`` off Spark fails on a file
    whose header differs.

    With ``keep_order`` an ``_src_order`` struct (file, block, position) is
    added so ``clean_dim(order_cols=["_src_order"])`` keeps the first row
    in file order; it is only comparable within a read.
    """
    reader = spark.read.option("header", True)
    header = reader.option("inferSchema", False).csv(path).columns
    missing = [f.name for f in CSV_TABLES[table].fields if f.name not in header]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")
    text = T.StructType([T.StructField(c, T.StringType()) for c in header])
    raw = reader.schema(text).option("enforceSchema", False).csv(path)
    target = TABLES[table]
    cols = []
    for f in target.fields:
        t = f.dataType
        if table == "fact_production" and f.name == "defective_qty":
            t = T.DoubleType()      # kept fractional until the clamp-and-round step
        cols.append(_typed(f.name, t).alias(f.name))
    if keep_order:
        cols.append(F.struct(F.col("_metadata.file_path").alias("file"),
                             F.col("_metadata.file_block_start").alias("block"),
                             F.monotonically_increasing_id().alias("pos")).alias(ORDER_COL))
    return raw.select(*cols)


def write_csv_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Header CSV; dates as ISO text, flags as 0/1."""
    df = df.drop(ORDER_COL) if ORDER_COL in df.columns else df
    df.write.mode(mode).option("header", True).csv(path)


def read_csv_star(spark: SparkSession, folder: str):
    """The seven CSV files of a star folder as a raw star (dims with ingest order)."""
    from shiftline.sources.fixtures import RawStar
    p = folder.rstrip("/")
    t = {n: read_csv_table(spark, f"{p}/{n}.csv", n, keep_order=n.startswith("dim_")) for n in TABLES}
    return RawStar(dim_plant=t["dim_plant"], dim_machine=t["dim_machine"], dim_shift=t["dim_shift"],
                   dim_product=t["dim_product"], dim_date=t["dim_date"],
                   raw_production=t["fact_production"], raw_maintenance=t["fact_maintenance"])
