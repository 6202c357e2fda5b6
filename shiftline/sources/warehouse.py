"""Parquet warehouse: full-refresh load (S4), reload, model persistence.

Facts are partitioned by calendar month and sorted by date inside each file.
A filter on the calendar (its year, quarter or month) prunes the month folders
at run time through the join with ``dim_date``, a date range prunes them when
planned, and inside a month the Parquet min/max statistics let a pushed-down
date predicate skip row groups. Writing the cleaned
tables also cuts the lineage: queries start from files, not from the raw
inputs and the validation joins.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftline.operators.cleaning import table_counts
from shiftline.operators.star import DIMS, FACTS, MONTH, Star, month_of
from shiftline.schemas import TABLES
from shiftline.session import remove_folder, shuffles_deleted

FACT_SORT = {"fact_production": ["date_id", "machine_id", "shift_id"],
             "fact_maintenance": ["date_id", "machine_id"]}


def _concurrently(tasks) -> None:
    """Run independent write jobs at once (Spark schedules jobs submitted
    from several threads side by side; small jobs no longer leave the
    cluster idle one after another). Errors are re-raised."""
    with ThreadPoolExecutor(max_workers=max(1, len(tasks))) as pool:
        for f in [pool.submit(t) for t in tasks]:
            f.result()


def _write_dims(dims: dict[str, DataFrame], base: str) -> None:
    # Cleaned dimensions end in an aggregation, so AQE coalesces a small
    # one into a single file and splits a large one.
    _concurrently([lambda n=name: dims[n].write.mode("overwrite").parquet(f"{base}/{n}") for name in DIMS])


def _write_fact(df: DataFrame, name: str, base: str, fact_files: int | None) -> None:
    """Partition a fact by calendar month and sort each file by date.

    A REBALANCE exchange on the month needs no sampling pass (range
    partitioning would evaluate the whole validation plan twice). AQE splits
    a hot month into several files of the same folder and merges small ones
    into one task, which then writes a file for each of its months.
    """
    x = df.withColumn(MONTH, month_of("date_id"))
    x = x.hint("rebalance", fact_files, MONTH) if fact_files else x.hint("rebalance", MONTH)
    x.sortWithinPartitions(MONTH, *FACT_SORT[name]).write.mode("overwrite").partitionBy(MONTH).parquet(f"{base}/{name}")


def write_star(star: Star, path: str, fact_files: int | None = None) -> None:
    """Drop-and-create all seven tables of an already-cleaned star under
    ``path/<table>``. ``fact_files``: partitions (files) per fact; by
    default AQE sizes them."""
    base = path.rstrip("/")
    _write_dims(star.dims(), base)
    _concurrently([lambda n=name: _write_fact(getattr(star, n), n, base, fact_files) for name in FACTS])


def load_raw_star(raw, path: str, fact_files: int | None = None,
                  dim_order: dict[str, list[str]] | None = None) -> Star:
    """E1 at scale: clean and write the dimensions, then validate the raw
    facts against the dimensions *read back from the warehouse* and write
    them. Dimensions are computed once and the fact plans start from the
    written dimension tables, whose file sizes the planner knows."""
    from shiftline.operators import cleaning
    from shiftline.operators.star import clean_dims
    spark = raw.raw_production.sparkSession
    base = path.rstrip("/")
    _write_dims(clean_dims(raw, dim_order), base)
    dims = {n: spark.read.parquet(f"{base}/{n}") for n in DIMS}
    prod = cleaning.clean_production(raw.raw_production, dims, getattr(raw, "slot_order", None))
    maint = cleaning.clean_maintenance(raw.raw_maintenance, dims)
    _concurrently([lambda: _write_fact(prod, "fact_production", base, fact_files),
                   lambda: _write_fact(maint, "fact_maintenance", base, fact_files)])
    return read_star(spark, base)


def read_star(spark: SparkSession, path: str) -> Star:
    """The written star; its facts also as ``parts``, with the month that their folders are named after."""
    base = path.rstrip("/")
    parts = {n: spark.read.schema(T.StructType([*TABLES[n].fields, T.StructField(MONTH, T.StringType())])).parquet(
        f"{base}/{n}") for n in FACTS}
    return Star(**{n: spark.read.parquet(f"{base}/{n}") for n in DIMS},
                **{n: parts[n].drop(MONTH) for n in FACTS}, parts=parts)


def refresh(raw, base: str, fact_files: int | None = None, check: bool = True,
            reported: Collection[tuple[str, str]] = ()) -> Star:
    """S4 as a snapshot swap: load into a new folder under ``base``, check the
    primary keys, NOT NULL columns and foreign keys of what was written, then
    publish it. Readers see the last published snapshot at all times; a load
    that fails or breaks a constraint (``ConstraintViolation``) publishes
    nothing and leaves no folder; violations of the (table, check) pairs in
    ``reported`` are a warning and stay in the tables. Older snapshots stay
    until ``prune``. Two loads at once both publish; readers take the later one."""
    from shiftline.operators import cleaning
    spark = raw.raw_production.sparkSession
    base, name = base.rstrip("/"), f"snapshot-{uuid.uuid4().hex}"
    try:
        with shuffles_deleted(spark):
            star = load_raw_star(raw, f"{base}/{name}", fact_files)
            if check:
                cleaning.assert_constraints(cleaning.constraint_report(star.tables()), reported)
    except Exception:
        remove_folder(spark, f"{base}/{name}")
        raise
    (spark.range(1).select(F.lit(name).alias("snapshot"), F.current_timestamp().alias("published_at"))
     .write.mode("append").parquet(f"{base}/published"))
    return star


def open_star(spark: SparkSession, base: str) -> Star | None:
    """The last published snapshot under ``base``; None if there is none."""
    base = base.rstrip("/")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{base}/published")
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return None
    last = spark.read.parquet(f"{base}/published").agg(F.max_by("snapshot", "published_at")).first()[0]
    return read_star(spark, f"{base}/{last}") if last else None


def prune(spark: SparkSession, base: str, keep: int = 1) -> list[str]:
    """Delete all but the ``keep`` last published snapshots under ``base`` and return their names.

    Never run by itself: a session that still reads an older snapshot loses it.
    """
    base = base.rstrip("/")
    newest = spark.read.parquet(f"{base}/published").orderBy(F.desc("published_at")).collect()   # a row a load
    old = [r.snapshot for r in newest[keep:]]
    for name in old:
        remove_folder(spark, f"{base}/{name}")
    return old


def input_version(spark: SparkSession, paths: list[str]) -> str:
    """Changes when a file under ``paths`` does (names, sizes, times; metadata only)."""
    parts = []
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [fs.getFileStatus(path)] if fs.getFileStatus(path).isFile() else list(fs.listStatus(path))
        parts += sorted(f"{s.getPath()} {s.getLen()} {s.getModificationTime()}" for s in found)
    return hashlib.sha256("\n".join(parts).encode()).hexdigest()[:16]


def full_refresh(star: Star, path: str, fact_files: int | None = None) -> DataFrame:
    """S4 + S5: write every table, then count rows from the written files."""
    write_star(star, path, fact_files)
    return table_counts(read_star(star.fact_production.sparkSession, path).tables())


def save_model(model, path: str, spark: SparkSession | None = None) -> None:
    """A model's encoding, its scorer as tables, and its ordered feature columns.

    ``model`` is a ``RiskModel``, or something fitted that has one as ``model``.
    """
    base, model = path.rstrip("/"), getattr(model, "model", model)
    spark, scorer = spark or SparkSession.active(), model.scorer
    model.encoding.model.write().overwrite().save(f"{base}/encoding")
    tables = {"nodes": scorer.nodes(spark),
              "margin": spark.createDataFrame([(type(scorer).__name__, scorer.base, getattr(scorer, "rate", 1.0))],
                                              "kind string, base double, rate double"),
              "feature_columns": spark.createDataFrame(list(enumerate(model.features)), "position int, feature string")}
    for name, df in tables.items():
        df.coalesce(1).write.mode("overwrite").parquet(f"{base}/{name}")


def load_model(spark: SparkSession, path: str):
    """(model, feature columns) of a stored model, in any session; the model's ``transform`` scores."""
    from pyspark.ml import PipelineModel
    from shiftline.operators import boosting, linear
    from shiftline.plans.risk import Encoding, RiskModel
    base = path.rstrip("/")
    cols = [r.feature for r in spark.read.parquet(f"{base}/feature_columns").orderBy("position").collect()]
    margin = spark.read.parquet(f"{base}/margin").first()
    kind = {c.__name__: c for c in (boosting.Boosted, linear.Linear)}[margin.kind]
    scorer = kind.from_nodes(spark.read.parquet(f"{base}/nodes"), margin.base, margin.rate)
    return RiskModel(Encoding(PipelineModel.load(f"{base}/encoding"), cols), scorer), cols


def is_empty(df: DataFrame) -> bool:
    """Emptiness guard (stops at the first row found)."""
    return df.isEmpty()
