"""Helpers shared by the operators: tables, intermediates, Arrow maps."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Cuts the lineage: later stages read files that every executor sees, so a
    lost executor costs a re-read and not a recomputation. Each call takes a
    new folder, which lasts until ``session.clear_scratch`` unless the caller
    removes it.
    """
    return stored(df, new_folder(df.sparkSession, name))


def new_folder(spark: SparkSession, name: str) -> str:
    return scratch_path(spark, f"llm/{name}-{uuid.uuid4().hex}")


def stored(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def map_rows(df: DataFrame, fn: Callable[..., tuple], schema: str, *args, owner: str = "") -> DataFrame:
    """Apply ``fn(*row, *args)`` to every row of ``df``, one output row each.

    ``fn`` sees one row at a time, so memory holds one Arrow batch and the
    Python values of ``SLICE`` rows; Spark keeps the partitioning, so nothing
    is shuffled.
    """
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                rows = [fn(*row, *args) for row in rows_of(part)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return arrow_map(df, run, schema, owner)


#: Rows whose Python values are held at once.
SLICE = 256


def slices(batch: pa.RecordBatch, rows: int = SLICE) -> Iterator[pa.RecordBatch]:
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def rows_of(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch as Python tuples, a slice at a time."""
    for part in slices(batch):
        yield from zip(*(c.to_pylist() for c in part.columns))


def keep_rows(df: DataFrame, columns: list[str], keep: Callable[..., bool], owner: str = "") -> DataFrame:
    """The rows of ``df`` for whose ``columns`` ``keep`` holds, with all columns as they are."""
    names = df.columns
    at = [names.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = rows_of(batch.select(at))
            yield batch.filter(pa.array([bool(keep(*row)) for row in cells], pa.bool_()))

    return arrow_map(df, run, df.schema, owner)


def arrow_map(df: DataFrame, run: Callable, schema: str, owner: str = "") -> DataFrame:
    """``df.mapInArrow`` whose workers can import this package.

    Spark reuses Python workers, so what an operator keeps in one (``kept``)
    outlives its tasks: tasks of another ``owner`` drop it first, and every
    task gives freed memory back at its end.
    """
    ship_package(df.sparkSession)

    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop_kept(owner)
        yield from run(batches)
        give_back()

    return df.mapInArrow(tidy, schema)


_kept: dict[str, tuple] = {}


def kept(owner: str, key, make: Callable):
    """``make()``, built once in this Python worker for as long as the owner's key stays the same."""
    held = _kept.get(owner)
    if held is None or not (held[0] is key or isinstance(key, str) and held[0] == key):
        _kept.pop(owner, None)
        _kept[owner] = held = (key, make())
    return held[1]


def drop_kept(owner: str) -> None:
    for other in [o for o in _kept if o != owner]:
        del _kept[other]


def give_back() -> None:
    """Hand memory that is free in this process back to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc only
    if trim is not None:
        trim(0)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors, once per application.

    Left out where they find it already: on the PYTHONPATH that they inherit,
    or in the working folder of a local master.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sc = spark.sparkContext
    known = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in known or (sc.master.startswith("local[") and os.getcwd() == root):
        return
    if sc.applicationId in _shipped:
        return
    archive = os.path.join(tempfile.mkdtemp(), "shiftline_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "shiftline")):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.relpath(path, root))
    sc.addPyFile(archive)  # from here on Spark serves it to every executor
    _shipped.add(sc.applicationId)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def constant(spark: SparkSession, names: str, rows: list[tuple]) -> DataFrame:
    """A small frame of Python values, built from literals inside the JVM."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names.split(), row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def fresh(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, in any letter case."""
    have = {c.lower() for c in df.columns}
    name = base
    while name.lower() in have:
        name += "_"
    return name


def id_bucket(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id's decimal text modulo ``modulus`` (null id: the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")),
                  F.lit(modulus))
