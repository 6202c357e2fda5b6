"""Quality classifier: supervised subword embeddings.

A document is the average of learned vectors, one for each word and each
character n-gram inside a word, hashed into ``BUCKETS`` rows; a softmax over
that average gives the class probabilities. Training is stochastic gradient
descent in numpy over a bounded sample of labelled documents; ``Settings``
holds that bound and every other parameter. A trained model is applied as one
number per bucket (its vector's logit difference), so scoring a text of any
length is a table lookup and a mean, block by block. A word equal to the one
before it counts as one more word, the same for all such repeats. Every
document also holds ``BLANK`` features with the zero vector, which keeps a
text of a few words near the learned bias.

Defined cases: a null text counts as empty; an empty text scores the learned
bias alone; with no usable label, or labels of one class only, every score is
that class's share (0.5 without labels). Null labels are not learned from; an
id labelled more than once counts as its lowest label. Rows that repeat score
alike, and a sample is chosen by a hash of the id, so reruns agree.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftline.llm import hashing
from shiftline.llm.common import arrow_map, id_bucket, keep_rows, map_rows

BUCKETS = 1 << 18
NGRAMS = (2, 3, 4)
BLANK = 20
REPEAT = 0


@dataclass(frozen=True)
class Settings:
    #: Labelled documents that the model is fitted on, at most.
    sample: int = 4000
    width: int = 16
    epochs: int = 6
    rate: float = 10.0
    #: Rows with crc32(doc_id) modulo this equal to 0 are never learned from.
    fold: int = 5
    seed: int = 42
    #: A document is predicted good from this score on.
    threshold: float = 0.3


def features(text: str) -> list[np.ndarray]:
    """Bucket numbers of all words and n-grams, block by block.

    An n-gram may begin or end with the white space beside a word but has
    none inside, so it never spans two words.
    """
    codes = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), "<u4")
    space = codes <= 32
    out = []
    for start, end in hashing.blocks(space):
        block, gap = codes[start:end], space[start:end]
        starts, ends = hashing.word_limits(gap)
        words = hashing.hash_words(block, starts, ends)
        out.append((words >> np.uint64(46)).astype(np.int32))
        out.append(np.full(int((words[1:] == words[:-1]).sum()), REPEAT, np.int32))
        padded = np.concatenate(([32], np.where(gap, 32, block), [32])).astype(np.uint64)
        solid = np.concatenate(([0], np.cumsum(np.concatenate(([True], gap, [True])))))
        gram = padded
        for n in range(2, max(NGRAMS) + 1):
            gram = gram[:-1] * hashing.STEP + padded[n - 1:]
            if n in NGRAMS:
                inside = solid[n - 1: len(padded)] - solid[1: len(padded) - n + 2]
                kept = gram[inside == 0] if n > 2 else gram
                out.append(((kept * np.uint64(hashing.BASE + 2 * n)) >> np.uint64(46)).astype(np.int32))
    return out


def _counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    found = features(text)
    if not found:
        return np.zeros(0, np.int32), np.zeros(0, np.float32)
    rows, counts = np.unique(np.concatenate(found), return_counts=True)
    return rows, (counts / (counts.sum() + BLANK)).astype(np.float32)


def fit(texts: list[str], labels: list[int], settings: Settings) -> tuple[np.ndarray, float]:
    """(logit of each bucket, bias) of the class 1 against the class 0."""
    y = np.array(labels, np.int64)
    share = float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if len(y) else 0.5
    bias = float(np.log(share / (1 - share)))
    if len(set(labels)) < 2:
        return np.zeros(BUCKETS, np.float32), bias
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (BUCKETS, settings.width)).astype(np.float32) / settings.width
    weights = np.zeros((2, settings.width), np.float32)
    offset = np.array([0.0, bias], np.float32)
    docs = [_counts(t) for t in texts]
    steps, step = settings.epochs * len(docs), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(docs)):
            rate = settings.rate * (1 - step / steps)
            step += 1
            rows, part = docs[k]
            hidden = part @ vectors[rows]
            logits = weights @ hidden + offset
            chance = np.exp(logits - logits.max())
            chance /= chance.sum()
            chance[y[k]] -= 1
            pull = weights.T @ chance
            weights -= 0.05 * rate / settings.rate * np.outer(chance, hidden) * settings.width
            offset -= 0.02 * rate / settings.rate * chance
            vectors[rows] -= rate * part[:, None] * pull
    return (vectors @ (weights[1] - weights[0])).astype(np.float32), float(offset[1] - offset[0])


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> tuple[np.ndarray, float]:
    """Fit on the sample of labelled ``docs`` outside the held-out fold.

    The sample meets in one task, as its size is bounded; the driver gets the
    fitted table only.
    """
    usable = labels.where(F.col("quality").isin(0, 1)).where(
        id_bucket(F.col("doc_id"), settings.fold) != 0).groupBy("doc_id").agg(
        F.min("quality").cast("int").alias("label"))
    chosen = usable.join(docs.select("doc_id").distinct(), "doc_id", "left_semi").orderBy(
        F.xxhash64(F.lit(settings.seed), "doc_id"), "doc_id").limit(settings.sample)
    order = [F.xxhash64(F.lit(settings.seed), "doc_id"), "doc_id", F.xxhash64("text")]
    # The second limit is for ids that stand on many rows.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").orderBy(*order).limit(
        settings.sample).select("label", "text").repartition(1).sortWithinPartitions(F.xxhash64("text"), "label", "text")

    def run(batches):
        labels, texts = [], []
        for batch in batches:
            labels += batch.column(0).to_pylist()
            texts += batch.column(1).to_pylist()
        table, bias = fit(texts, labels, settings)
        yield pa.RecordBatch.from_pydict({"model": [table.tobytes()], "bias": [bias]})

    rows = arrow_map(sample, run, "model binary, bias double").collect()
    if not rows:
        return fit([], [], settings)
    return np.frombuffer(bytes(rows[0].model), np.float32), rows[0].bias


def score_text(text: str | None, model: tuple[np.ndarray, float]) -> float:
    logits, bias = model
    total, count = 0.0, BLANK
    for found in features(text):
        total += float(logits[found].sum(dtype=np.float64))
        count += len(found)
    return float(1 / (1 + np.exp(-np.clip(bias + total / count, -50, 50))))


def score(docs: DataFrame, model: tuple[np.ndarray, float], keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns and score (0 to 1): the probability of label 1."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def row(*cells):
        *kept, text = cells
        return (*kept, score_text(text, held.value))

    kept = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return map_rows(docs.select(*keep, "text"), row, f"{kept}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that the classifier predicts good, all columns unchanged."""
    held = docs.sparkSession.sparkContext.broadcast(train(docs, labels, settings))
    return keep_rows(docs, ["text"], lambda text: score_text(text, held.value) >= settings.threshold)


def classify(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of ``docs``."""
    scored = score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                   train(docs, labels, settings))
    return scored.select(
        "doc_id", (id_bucket(F.col("doc_id"), settings.fold) == 0).alias("held_out"), "score",
        (F.col("score") >= settings.threshold).cast("int").alias("predicted"))
