"""Validated fact ingest as a Structured Streaming query.

New CSV files landing in a folder are validated with exactly the batch
rules (``operators.cleaning``): the dimension lookups are stream–static
left joins, the bounds are column predicates. Each micro-batch writes its
clean rows and its reject counts; batches are written under their batch id
with overwrite semantics, so a retried batch replaces its own output
(idempotent sink) and progress is tracked in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from shiftline.operators import cleaning
from shiftline.schemas import TABLES
from shiftline.sources.files import _text_schema, _typed

# per fact: (validation, post-validation transform)
_RULES = {
    "fact_production": (cleaning.flag_production, cleaning.clamp_defective),
    "fact_maintenance": (cleaning.flag_maintenance, lambda df: df),
}


def fact_stream(spark: SparkSession, source_dir: str, table: str = "fact_production",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """New CSV files of a fact as a typed stream. A streaming source needs
    a schema, which CSV applies by position; ``enforceSchema=false`` makes
    Spark check every file's header against it, so a file with other
    columns fails instead of being read into the wrong fields."""
    reader = (spark.readStream.schema(_text_schema(table)).option("header", True)
              .option("enforceSchema", False))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(source_dir)
    cols = [_typed(f.name, T.DoubleType() if f.name == "defective_qty" else f.dataType).alias(f.name)
            for f in TABLES[table].fields]
    return raw.select(*cols)


def start_validated_ingest(spark: SparkSession, source_dir: str, dims: dict[str, DataFrame],
                           sink_dir: str, checkpoint: str, available_now: bool = True,
                           max_files_per_trigger: int | None = None,
                           table: str = "fact_production") -> StreamingQuery:
    """Start the stream for ``table``; ``sink_dir/clean`` gets loadable rows,
    ``sink_dir/rejects`` gets (table_name, status, n_rows, batch_id)."""
    flag, finish = _RULES[table]
    flagged = flag(fact_stream(spark, source_dir, table, max_files_per_trigger), dims)
    schema = TABLES[table]
    base = sink_dir.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            clean = finish(batch.where(F.col(cleaning.REASON).isNull()))
            clean = clean.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
            clean.write.mode("overwrite").parquet(f"{base}/clean/batch_id={batch_id}")
            (cleaning.fact_reject_counts(batch, table).withColumn("batch_id", F.lit(batch_id))
             .coalesce(1).write.mode("overwrite").parquet(f"{base}/rejects/batch_id={batch_id}"))
        finally:
            batch.unpersist()

    w = flagged.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
