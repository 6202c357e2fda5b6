"""Exact top-k search of binary codes by incremental multi-index hashing.

A vector's code holds one bit for each of its components, in words of ``BITS``:
1 if it is above zero. The longest vector gives the number of words. Codes are
cut into segments of ``WIDTH`` bits, and a table for each segment lists the
codes by its value. A query looks up the values within radius 0, 1, 2, ... of
its own in every table; two codes that differ by at most segments * (radius + 1)
- 1 bits have a segment that differs by at most the radius, so the search ends
once the k-th verified distance is within that bound.

Equal codes are one class with its ``k + 1`` smallest ids, so a vector that
many rows share costs no more than another, and equal queries are searched
once. Spark deals classes to blocks of about ``BLOCK_CODES`` by a hash, each
with the queries in blocks of at most ``BLOCK_QUERIES``, fewer where that leaves
executors idle; a task searches its block and
returns at most k + 1 classes a query; the nearest of all blocks are the
result.

Defined cases: a null vector has no code and is neither found nor a query; a
component that is null, NaN or missing at the end is bit 0; a row without an id
is neither found nor a query; a query does not find its
own row, but rows equal to it, at distance 0; ties go to the smaller id; fewer
than k other rows give fewer results; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.common import arrow_map, rows_of

BITS, WIDTH = 64, 16
BLOCK_CODES = 1 << 16
BLOCK_QUERIES = 1 << 10
LEAST_QUERIES = 1 << 6
MOST_TASKS = 10_000


def code_of(vector: Column, words: int) -> Column:
    """An array of ``words`` longs, component i as bit i % BITS of word i // BITS."""
    def word(at: int) -> Column:
        bits = F.transform(F.slice(vector, at * BITS + 1, BITS), lambda x, i: F.when(
            (x > 0) & ~F.isnan(x), F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long")))
        return F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(vector.isNotNull(), F.array(*[word(at) for at in range(words)]))


@lru_cache(maxsize=None)
def _masks(radius: int) -> np.ndarray:
    """All segment values with ``radius`` bits set."""
    return np.array([sum(1 << b for b in c) for c in combinations(range(WIDTH), radius)], np.int64)


class Tables:
    """For each segment: the codes sorted by its value, and where each value starts."""

    def __init__(self, codes: np.ndarray):
        """``codes``: a row of words for each code."""
        self.codes, self.tables = codes, []
        for s in range(codes.shape[1] * BITS // WIDTH):
            values = _segment(codes, s)
            order = np.argsort(values, kind="stable")
            self.tables.append((order, np.searchsorted(values[order], np.arange((1 << WIDTH) + 1))))

    def nearest(self, query: np.ndarray, sizes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions and distances of the codes up to the k-th nearest row, with all ties."""
        seen = np.zeros(len(self.codes), bool)
        at, distance = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for radius in range(WIDTH + 1):
            found = []
            for s, (order, starts) in enumerate(self.tables):
                values = int(_segment(query, s)) ^ _masks(radius)
                first, counts = starts[values], starts[values + 1] - starts[values]
                some = counts > 0
                first, counts = first[some], counts[some]
                if len(counts):
                    ends = np.cumsum(counts)
                    found.append(order[np.arange(ends[-1]) + np.repeat(first - (ends - counts), counts)])
            if found:
                new = np.unique(np.concatenate(found))
                new = new[~seen[new]]
                seen[new] = True
                at = np.concatenate((at, new))
                distance = np.concatenate((distance, np.bitwise_count(self.codes[new] ^ query).sum(axis=1, dtype=np.int64)))
            covered = len(self.tables) * (radius + 1) - 1
            near = distance <= covered
            if sizes[at[near]].sum() >= k or len(at) == len(self.codes):
                break
        order = np.argsort(distance, kind="stable")
        at, distance = at[order], distance[order]
        upto = np.searchsorted(np.cumsum(sizes[at]), k)
        last = distance[min(upto, len(distance) - 1)] if len(distance) else 0
        return at[distance <= last], distance[distance <= last]


def _segment(codes: np.ndarray, s: int):
    word, shift = divmod(s * WIDTH, BITS)
    return ((codes[..., word] >> np.uint64(shift)) & np.uint64((1 << WIDTH) - 1)).astype(np.int64)


def search(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """query_id, rank, neighbour_id, distance: the k nearest other rows of each query.

    ``vectors``: vec_id, embedding; ``is_query`` is a condition on vec_id.
    """
    held = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(F.col("vec_id").isNotNull())
    longest = held.agg(F.max(F.size("embedding"))).first()[0]
    coded = held.select("vec_id", code_of(F.col("embedding"), -(-max(1, longest or 0) // BITS)).alias("code")).where(
        F.col("code").isNotNull())
    by_code = Window.partitionBy("code").orderBy(F.col("vec_id").asc_nulls_last())
    classes = coded.withColumn("place", F.row_number().over(by_code)).where(F.col("place") <= k + 1).groupBy(
        "code").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asked = coded.where(is_query)
    queries = asked.select("code").distinct()
    n_codes, n_queries = classes.count(), queries.count()
    blocks = -(-n_codes // BLOCK_CODES) or 1
    idle = -(-vectors.sparkSession.sparkContext.defaultParallelism // blocks)
    parts = max(-(-n_queries // BLOCK_QUERIES), min(-(-n_queries // LEAST_QUERIES), idle), 1)
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    none = F.lit(None).cast("array<long>")
    dealt = classes.select("code", "ids", F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int").alias("block"),
                           upto(parts).alias("part")).unionByName(
        queries.select("code", none.alias("ids"), upto(blocks).alias("block"),
                       F.pmod(F.xxhash64("code", F.lit(1)), F.lit(parts)).cast("int").alias("part")))
    # With a number of partitions given, small groups are not merged into one task.
    grouped = dealt.repartition(min(blocks * parts, MOST_TASKS), "block", "part").sortWithinPartitions("block", "part").select(
        "block", "part", "code", "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key = [], None
        for batch in batches:
            for row in rows_of(batch):
                if row[:2] != key:
                    yield from _search_block(group, k + 1)
                    group, key = [], row[:2]
                group.append(row[2:])
        yield from _search_block(group, k + 1)

    found = arrow_map(grouped, run, "code array<long>, ids array<long>, distance int")
    # Nearest of all blocks; a class brings at most k + 1 ids.
    rows = found.select("code", "distance", F.explode("ids").alias("neighbour_id"))
    nearest = Window.partitionBy("code").orderBy("distance", "neighbour_id")
    best = rows.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1)
    own = asked.select("code", F.col("vec_id").alias("query_id")).join(best, "code").where(
        F.col("query_id") != F.col("neighbour_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "neighbour_id"))
    return own.withColumn("rank", rank).where(F.col("rank") <= k).select(
        "query_id", "rank", "neighbour_id", "distance")


def _search_block(group: list[tuple], k: int) -> Iterator[pa.RecordBatch]:
    """For every query code of a block the nearest classes: (code, ids, distance)."""
    held = [(code, ids) for code, ids in group if ids is not None]
    asked = [code for code, ids in group if ids is None]
    if not held or not asked:
        return
    codes = np.array([c for c, _ in held], np.int64).reshape(len(held), -1).view(np.uint64)
    sizes = np.array([len(ids) for _, ids in held])
    tables = Tables(codes)
    out = []
    for code in asked:
        at, distance = tables.nearest(np.array(code, np.int64).view(np.uint64), sizes, k)
        out += [(code, held[p][1], int(d)) for p, d in zip(at, distance)]
    columns = zip(*out)
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int32()))],
        names=["code", "ids", "distance"])
