"""Target-distribution importance resampling: documents that read like a target are drawn more often.

1. ``gains``: features of all documents and of all target texts are counted by
   hash bucket; a bucket's gain is the log ratio of its two smoothed shares, in
   thousandths, rounded down. Counts of a batch are summed before they leave
   their task, and the table of gains has ``Settings.buckets`` numbers at any
   size of the corpus, which is what is sent to the executors.
2. ``scored``: a document's features index the array of gains; its weight is
   the mean, rounded down, and its score adds Gumbel noise from a hash of its
   id, so that the highest scores are a draw without replacement.
3. ``resample``: documents of at least ``least`` words are ranked by (score
   descending, doc_id) in a distributed radix sort (``radix``), and the first
   ``percent`` of a hundred of them are drawn.

Features are words, or runs of up to ``longest`` words joined by one space.
Texts are read as UTF-8 bytes, at most ``Settings.piece`` at a time (longer only for a
single longer word), so a very long text needs no long list.

Defined cases: a null or empty text has no features and weight 0; so has every
document if there is no target. A null doc_id is hashed as the empty text and
comes after all others of its score. Rows that repeat count each; rows equal in
score and id are ordered by their number of features, and those equal in that
too are the same row of the result. An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.llm import radix
from shiftline.llm.common import arrow_map, map_rows, rows_of, written

#: Words as UTF-8: ASCII digits and letters, and all bytes of other characters.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
GAP = re.compile(rb"[^0-9A-Za-z\x80-\xff]")


@dataclass(frozen=True)
class Settings:
    buckets: int = 10_000
    #: Words of the longest feature.
    longest: int = 1
    seed: int = 2024
    #: Words a document needs to be drawn; share of those documents that is drawn.
    least: int = 20
    percent: int = 10
    #: Bytes of a text that are cut into words at once.
    piece: int = 1 << 20


def pieces(text: bytes, size: int) -> Iterator[bytes]:
    """The text in parts, cut only between words."""
    start = 0
    while start < len(text):
        gap = GAP.search(text, start + size)
        end = gap.end() if gap else len(text)
        yield text[start:end]
        start = end


def features(text: bytes | None, settings: Settings) -> Iterator[tuple[int, np.ndarray]]:
    """Number of words and buckets of the features, part by part of the text."""
    tail: list[bytes] = []
    for piece in pieces(text or b"", settings.piece):
        runs = words = WORD.findall(piece.lower())
        n = len(words)
        if settings.longest > 1:
            words = tail + words
            runs = [b" ".join(words[end - k: end]) for end in range(len(tail) + 1, len(words) + 1)
                    for k in range(1, min(settings.longest, end) + 1)]
            tail = words[1 - settings.longest:]
        yield n, np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % settings.buckets


def bucket_counts(texts: DataFrame, settings: Settings) -> np.ndarray:
    """Features of all texts by bucket."""
    def count(batches):
        total = np.zeros(settings.buckets, np.int64)
        for batch in batches:
            for (text,) in rows_of(batch):
                for _, found in features(text, settings):
                    total += np.bincount(found, minlength=settings.buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at])], names=["bucket", "n"])

    found = arrow_map(texts.select(F.col("text").cast("binary")), count, "bucket long, n long").groupBy("bucket").agg(
        F.sum("n").alias("n")).toArrow()                       # one row a bucket
    out = np.zeros(settings.buckets, np.int64)
    out[found["bucket"].to_numpy()] = found["n"].to_numpy()
    return out


def gains(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> np.ndarray:
    """Every bucket's gain in thousandths, as floor(1000 ln ratio) of doubles."""
    s, t = (bucket_counts(df, settings).astype(np.float64) for df in (docs, target))
    k = float(settings.buckets)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def noise(doc_id: Column, seed: int) -> Column:
    """Gumbel noise in thousandths, from the first eight hex digits of a hash of the id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def scored(docs: DataFrame, gain: np.ndarray, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_features, n_words, weight, score of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(gain)

    def row(doc_id, text):
        total = n_features = n_words = 0
        for n, found in features(text, settings):
            total += int(held.value[found].sum())
            n_features += len(found)
            n_words += n
        return doc_id, n_features, n_words, total // n_features if n_features else 0

    weighed = map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary")),
                       row, "doc_id long, n_features long, n_words long, weight long")
    return weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), settings.seed))


def resample(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_features, weight, score and rank (null if not drawn) of every row of ``docs``."""
    cells = written(scored(docs, gains(docs, target, settings), settings), "scores")
    out = ["doc_id", "n_features", "weight", "score"]
    able = cells.where(F.col("n_words") >= settings.least).select(*out)
    ranked = radix.rank(able, [("score", True), ("doc_id", False), ("n_features", False)], "rank")
    drawn = F.floor(able.select(F.count(F.lit(1))).scalar() * settings.percent / 100)
    short = cells.where(F.col("n_words") < settings.least).select(*out, F.lit(None).cast("long").alias("rank"))
    return ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank"))).unionByName(short)


def draw(docs: DataFrame, target: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` whose ids are drawn, all columns unchanged."""
    drawn = resample(docs, target, settings).where(F.col("rank").isNotNull()).select("doc_id").distinct()
    return docs.join(drawn, docs["doc_id"].cast("long").eqNullSafe(drawn["doc_id"]), "left_semi")
