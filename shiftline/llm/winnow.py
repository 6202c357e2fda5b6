"""Document fingerprints by winnowing.

Every ``K`` consecutive characters have a hash; of every ``WINDOW``
consecutive hashes the smallest is kept, the rightmost of equal ones, with
its position. Any passage of at least ``WINDOW + K - 1`` characters that two
texts share then gives both at least one common fingerprint. A text with
fewer characters than that has the smallest of the hashes it has (one hash of
the whole text if it is shorter than K).

Hashes are computed block by block, so memory is bounded by ``BLOCK`` and the
number of fingerprints of one text.

``with_next`` pairs each document with the one that follows it in descending
doc_id (after the last: the first). Documents are range partitioned and sorted
inside each partition, where neighbours are met row by row; only the last row
of a partition waits for the first row of the one after it. That is one
shuffle of the texts and no join. Rows that share an id are ordered by a hash
of the text and then the text; a null id comes last.

Defined cases: a null text counts as empty; the empty text has no hashes and
is like another empty text (1) and unlike any other (0); with one document,
its next is itself; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm import hashing
from shiftline.llm.common import arrow_map, arrow_schema, map_rows, rows_of, written

K = 16
WINDOW = 16
BLOCK = 1 << 18


def fingerprint(text: str | None, k: int = K, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) that winnowing keeps, by position."""
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    k = min(k, n)
    window = min(window, n - k + 1)
    hashes, positions, last = [], [], -1
    for start in range(0, n - k - window + 2, BLOCK):
        part = _grams(codes[start: start + BLOCK + window + k - 2], k)
        at = _rightmost_minima(part, window) + start
        first = np.searchsorted(at, last, "right")
        if first < len(at):
            at = at[first:]
            hashes.append(part[at - start])
            positions.append(at)
            last = at[-1]
    return np.concatenate(hashes), np.concatenate(positions)


def _grams(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive codes, by doubling the width."""
    out, width, power = codes.astype(np.uint64) + np.uint64(1), 1, hashing.BASE
    whole, done, at = None, 0, k
    while at:
        if at & 1:
            if whole is None:
                whole, done = out, width
            else:
                size = len(out) - done
                whole = whole[:size] * np.uint64(power) + out[done:]
                done += width
        at >>= 1
        if at:
            out = out[:-width] * np.uint64(power) + out[width:]
            width *= 2
            power = power * power % (1 << 64)
    return hashing.mix(whole)


def _rightmost_minima(hashes: np.ndarray, window: int) -> np.ndarray:
    """Positions of the minimum of each window, the rightmost of equal ones, each once."""
    n = len(hashes) - window + 1
    low, at, width = hashes, np.arange(len(hashes)), 1
    while width < window:
        step = min(width, window - width)
        right, right_at = low[step:], at[step:]
        size = len(right)
        take = right <= low[:size]
        low, at = np.where(take, right, low[:size]), np.where(take, right_at, at[:size])
        width += step
    at = at[:n]
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def digest(hashes: np.ndarray) -> str:
    """One string for a fingerprint: equal exactly if the kept hashes and their order are."""
    return hashlib.sha256(hashes.astype("<u8").tobytes()).hexdigest()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted arrays of distinct hashes."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def fingerprints(docs: DataFrame, keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns, hashes and positions array<long> of every text."""
    def row(*cells):
        *kept, text = cells
        hashes, positions = fingerprint(text)
        return (*kept, hashes.view(np.int64), positions)
    kept = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return map_rows(docs.select(*keep, "text"), row, f"{kept}, hashes array<long>, positions array<long>")


def edited(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compare(doc_id: int | None, text: str, own: tuple, following: str, next_hashes: np.ndarray) -> dict:
    """The result row of a document, its fingerprint given, and the text after it."""
    changed = edited(text, following)
    hashes, distinct = own
    other = hashes if changed == text else fingerprint(changed)[0]
    return {"doc_id": doc_id, "n_chars": len(text),
            "edited_sha256": hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest(),
            "fingerprint": digest(hashes), "edited_fingerprint": digest(other),
            "near_edited": likeness(distinct, np.unique(other)),
            "near_next": likeness(distinct, next_hashes), "n_hashes": len(distinct)}


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
          "edited_fingerprint string, near_edited double, near_next double, n_hashes long")


def with_next(docs: DataFrame) -> DataFrame:
    """Each document against its edited text and against the next document."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tie = F.xxhash64("text")
    order = [F.col("doc_id").desc_nulls_last(), tie, F.col("text")]
    ranges = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.coalesce("text", F.lit("")).alias("text")).repartitionByRange(
        parts, *order[:2]).sortWithinPartitions(*order)
    schema = f"part int, head_text string, tail_text string, {RESULT}"
    arrow = arrow_schema(spark, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        head = last = None
        for batch in batches:
            rows = []
            for doc_id, text in rows_of(batch):
                hashes = fingerprint(text)[0]
                own = hashes, np.unique(hashes)
                if last is None:
                    head = text
                else:
                    rows.append({"part": part, **compare(*last, text, own[1])})
                last = doc_id, text, own
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        if last is not None:
            # The next of a part's last row is the first of a later part.
            yield pa.RecordBatch.from_pylist(
                [{"part": part, "doc_id": last[0], "head_text": head, "tail_text": last[1]}], schema=arrow)

    done = written(arrow_map(ranges, run, schema), "winnow")
    # Only the numbers of the parts are ordered in one task; the texts at their ends meet by number.
    ends = done.where(F.col("tail_text").isNotNull())
    along = Window.orderBy("part")
    after = ends.select("part", F.coalesce(
        F.lead("part").over(along),
        F.first("part").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))).alias("next"))
    edges = ends.select("part", "doc_id", "tail_text").join(after, "part").join(
        ends.select(F.col("part").alias("next"), F.col("head_text").alias("next_text")), "next").select(
        "doc_id", "tail_text", "next_text")

    def edge(doc_id, text, following):
        hashes = fingerprint(text)[0]
        return tuple(compare(doc_id, text, (hashes, np.unique(hashes)), following,
                             np.unique(fingerprint(following)[0])).values())

    inner = done.where(F.col("tail_text").isNull()).drop("part", "head_text", "tail_text")
    return inner.unionByName(map_rows(edges, edge, RESULT))
