"""Language identification, word first with backoff to character n-grams.

A word known from training adds its log frequency in every language. An
unseen word backs off: its character n-grams of the longest order count if
any of them is known, else those one shorter, down to single letters. The
sums, with the languages' log shares of the training rows as a prior, are
turned into probabilities.

Learning: per language ``docs`` labelled documents with low hashes of their ids
give the word and n-gram counts. Every counted word and n-gram is in the model,
so its size is bounded by ``docs`` whole texts a language. The language shares
count every training row. ``lang`` is taken to have few distinct values: the
model has a number for each key and language.

Defined cases: a null text, or one without a letter, is ``und`` with score 0;
so is every text if nothing could be learned. Ties go to the first language by
code point. Null languages are not learned from. Rows that repeat are
predicted alike; reruns agree. Words are cut from the whole text, a bounded
number at a time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.common import arrow_map, id_bucket, keep_rows, kept, map_rows, rows_of

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
CHUNK = 100_000
#: Rows (an id and a language) that may be sent to every executor.
BROADCAST = 100_000
#: Unseen words whose scores a Python worker keeps, and numbers it keeps for them.
MAX_WORDS = 1 << 17
MAX_SCORES = 1 << 22


@dataclass(frozen=True)
class Settings:
    #: Documents learned from, per language.
    docs: int = 1500
    orders: tuple[int, ...] = (4, 3, 2, 1)
    #: Rows with crc32(doc_id) modulo ``fold`` equal to ``held`` are never learned from.
    fold: int = 4
    held: int = 2
    seed: int = 42
    #: A filter keeps a document from this score on.
    sure: float = 0.5


def words_of(text: str) -> Iterator[str]:
    return (m.group() for m in LETTERS.finditer(text.lower()))


def grams_of(word: str, order: int) -> list[str]:
    padded = word if order == 1 else f" {word} "
    return [padded[k: k + order] for k in range(len(padded) - order + 1)]


def learn(docs: DataFrame, settings: Settings = Settings()) -> dict:
    """The model: languages, their log shares, keys by order (0: words) and log frequencies."""
    usable = docs.where(F.col("lang").isNotNull()).where(
        id_bucket(F.col("doc_id"), settings.fold) != settings.held)
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    shares = sorted((r.lang, r.n) for r in sizes.collect())
    # Of a language with many rows only those below a share of the hash range can be chosen, four times as many
    # as needed on average, so the rows ordered in one task do not grow with the language.
    h = F.xxhash64(F.lit(settings.seed), "doc_id")
    near = h.bitwiseAND(F.lit((1 << 63) - 1)) / float(1 << 63) <= 4.0 * settings.docs / F.col("n")
    low = usable.join(F.broadcast(sizes) if len(shares) <= BROADCAST else sizes, "lang").where(near).select("doc_id", "lang", h.alias("place")).distinct()
    order = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = low.withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= settings.docs).select("doc_id", "lang")
    if len(shares) * settings.docs <= BROADCAST:      # else the planner decides
        chosen = F.broadcast(chosen)
    sample = docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])

    def count(batches):
        for batch in batches:
            words: dict[str, Counter] = {}
            for lang, text in rows_of(batch):
                own, found = words.setdefault(lang, Counter()), words_of(text or "")
                while part := list(islice(found, CHUNK)):
                    own.update(part)
            rows = []
            for lang, own in words.items():
                rows += [(lang, 0, w, n) for w, n in own.items()]
                for k in settings.orders:
                    grams = Counter()
                    for w, n in own.items():
                        for g in grams_of(w, k):
                            grams[g] += n
                    rows += [(lang, k, g, n) for g, n in grams.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.int32(), pa.string(), pa.int64()))],
                    names=["lang", "kind", "gram", "n"])

    counts = arrow_map(
        sample.select("lang", "text"), count, "lang string, kind int, gram string, n long").groupBy("lang", "kind", "gram").agg(
        F.sum("n").alias("n"))
    found = counts.toArrow()
    langs = [lang for lang, _ in shares]
    prior = np.log(np.array([n for _, n in shares], float) / max(1, sum(n for _, n in shares)))
    return {"langs": langs, "prior": prior,
            "logs": {k: _log_table(found.filter(pc.equal(found["kind"], k)), langs)
                     for k in (0, *settings.orders)}}


def _log_table(found: pa.Table, langs: list[str]) -> tuple[list[str], np.ndarray]:
    """Sorted keys and each key's log frequency by language, half a count where unseen."""
    grams = found["gram"].to_pylist()
    keys = sorted(set(grams))
    at, column = {g: k for k, g in enumerate(keys)}, {lang: k for k, lang in enumerate(langs)}
    totals = np.zeros(len(langs))
    counts = np.full((len(keys), len(langs)), 0.5)
    for lang, gram, n in zip(found["lang"].to_pylist(), grams, found["n"].to_pylist()):
        counts[at[gram], column[lang]] = n
        totals[column[lang]] += n
    totals[totals == 0] = 1
    return keys, np.log(counts / (totals + 0.5 * len(keys))).astype(np.float32)


class Scorer(dict):
    """Word -> row of ``self.rows``; an unseen word gets its row by backoff."""

    def __init__(self, model: dict):
        super().__init__()
        self.langs, self.prior = model["langs"], model["prior"]
        keys, logs = model["logs"][0]
        self.known, self.known_rows = {w: k for k, w in enumerate(keys)}, logs
        self.grams = [(k, {g: at for at, g in enumerate(model["logs"][k][0])}) for k in sorted(model["logs"], reverse=True) if k]
        self.gram_rows = {k: model["logs"][k][1] for k, _ in self.grams}
        self.blank = np.zeros(len(self.langs), np.float32)
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.update(self.known)
        self.room = min(MAX_WORDS, MAX_SCORES // max(1, len(self.langs)))
        self.rows = np.zeros((len(self.known) + self.room + CHUNK, len(self.langs)), np.float32)
        self.rows[: len(self.known)] = self.known_rows

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.rows[at] = self.back_off(word)
        return at

    def back_off(self, word: str) -> np.ndarray:
        for order, places in self.grams:
            found = [at for g in grams_of(word, order) if (at := places.get(g)) is not None]
            if found:
                return self.gram_rows[order][found].sum(axis=0) / order
        return self.blank

    def predict(self, text: str | None) -> tuple[str, float]:
        found = words_of(text or "")
        total, any_letter = self.prior.copy(), False
        while part := list(islice(found, CHUNK)):
            if len(self) - len(self.known) > self.room:
                self.reset()
            # The pattern also takes other numerals, such as a superscript two.
            any_letter = any_letter or any(c.isalpha() for word in part for c in word)
            rows = np.fromiter(map(self.__getitem__, part), np.int64, len(part))
            total += self.rows[rows].sum(axis=0, dtype=np.float64)
        if not any_letter or not self.langs:
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def _scorer_of(model: dict) -> Scorer:
    """The scorer of this Python worker, with the words it has met."""
    return kept("language", model, lambda: Scorer(model))


def predict(docs: DataFrame, model: dict, keep: tuple = ("doc_id",)) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row of ``docs``."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def row(*cells):
        *own, text = cells
        return (*own, *_scorer_of(held.value).predict(text))

    names = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes)
    return map_rows(docs.select(*keep, "text"), row, f"{names}, lang_pred string, score double", owner="language")


def keep_known(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` with a language of score ``settings.sure`` or more, all columns unchanged."""
    held = docs.sparkSession.sparkContext.broadcast(learn(docs, settings))

    def keep(text: str | None) -> bool:
        lang, score = _scorer_of(held.value).predict(text)
        return lang != UNKNOWN and score >= settings.sure

    return keep_rows(docs, ["text"], keep, owner="language")


def identify(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row of ``docs``."""
    predicted = predict(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"),
                        learn(docs, settings))
    return predicted.select(
        "doc_id", (id_bucket(F.col("doc_id"), settings.fold) == settings.held).alias("held_out"),
        "lang_pred", "score")
