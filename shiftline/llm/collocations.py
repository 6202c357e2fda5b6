"""Phrase collocations from stripes: each prefix keys a counter of the words that follow it.

Level m has the stripes of prefixes of m - 1 words. A stripe's entries are the
counts of the phrases prefix + next word and its largest entry is the most
frequent extension to the right; a prefix's total is its own entry in the
stripe one word shorter, and the empty prefix has the number of all words.

1. What may be frequent: a task numbers the words of a chunk and numpy counts
   its phrases of m words by hash, only those whose first and last m - 1 words
   may be frequent. The counts travel as bundles of 2**``SLOTS`` hashes and are
   added in an array of that size; hashes that reach ``least`` set a bitmap of
   2**``bits`` places, which is what the tasks get. Its size is fixed; collisions
   and a full bitmap let more through and change no count. The hashes have
   three bits more than the number of all words.
2. Stripes: a task counts (prefix, next) pairs of phrases that the bitmap may
   hold, exactly, by its word numbers, and gives them out in bundles of stripes,
   a bundle for each group of prefixes. The bundles of a group meet and their
   stripes are added element by element; counts below ``least`` are dropped
   then. There are as many groups as keep one at about ``group`` phrases. The
   empty prefix, and a prefix of hot words only (each at least 1/``hot`` of all
   words, so at most ``hot`` of them), is dealt over all groups by its next words.
3. After the bitmap of level 2 the words outside such pairs are left out of the
   texts once, for all that follows.
4. Scores, cuts and subsumption are joins over the frequent phrases.

Phrases that a longer one covers: a phrase's frequency is at least that of any
phrase it lies in, so the most frequent extension by one word to the left or
to the right decides for all longer ones.

Defined cases: a null text has no words; a null lang is ``und``, together with
rows that say so; rows that repeat count each; doc_id and other columns are
ignored; an empty table, or one without a frequent phrase, gives an empty
result. Ties go to the smaller phrase by UTF-8 bytes. Texts are cut at piece
ends into parts of about ``part`` bytes, so a task holds one chunk of words, or
one piece that is longer. Scores are divided exactly as decimals of 38 digits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import compress, crc32, decompress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.common import arrow_map, arrow_schema, rows_of, slices, written
from shiftline.llm.hashing import STEP, mix

UNKNOWN = "und"
#: Piece ends become full stops, a tab a blank.
BREAKS = bytes.maketrans(b".,;:!?\n\x0b\x0c\r\t", b".......... ")
STRIPES = "lang string, prefix string, total long, next array<string>, n array<long>"
BUNDLE = ("grp int, lang array<string>, prefix array<string>, total array<long>, next array<array<string>>, "
          "n array<array<long>>")
#: Bits of the hashes that are added in one array; bits of a hash at most.
SLOTS, MOST_BITS = 22, 40
COUNTS = "grp int, once binary, often binary, n binary"
RESULT = "lang string, rank long, phrase string, a long, l long, r long, n long, score long"


@dataclass(frozen=True)
class Settings:
    longest: int = 5
    least: int = 100
    #: A phrase goes if a longer one has this per cent of its occurrences.
    share: int = 100
    top: int = 2000
    hot: int = 1000
    #: Phrases merged together, about.
    group: int = 50_000
    bits: int = 26
    #: Bits of the hashes that phrases are first counted by, at least.
    hash_bits: int = 30
    #: Words counted together in a task, and bytes of the parts that texts are cut into.
    chunk: int = 1 << 20
    part: int = 1 << 20


class Numbers(dict):
    """Word -> number in order of first use; a full stop is 0."""

    def __init__(self):
        super().__init__({b".": 0})

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self)
        return at


def words_of(text: bytes | None, part: int) -> Iterator[list[bytes]]:
    """Words of the text part by part, a full stop at every piece's end."""
    text, start = (text or b"").lower().translate(BREAKS), 0
    while start < len(text):
        end = text.find(b".", start + part)
        end = len(text) if end < 0 else end + 1
        yield [*text[start:end].replace(b".", b" . ").split(), b"."]
        start = end


def hashes_of(words: list[bytes]) -> np.ndarray:
    """Hashes for the bitmap only: words that share one let more through and change no count."""
    return mix(np.fromiter(map(crc32, words), np.uint64, len(words)) + STEP)


def chain(start: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    """Hashes of phrases from the hash of their language and those of their words."""
    for h in words:
        start = mix(start * STEP + h)
    return start


class Bitmap:
    """Places of phrases that may be frequent."""

    def __init__(self, bits: int, at: np.ndarray, cells: np.ndarray):
        self.mask = np.uint64((1 << bits) - 1)
        self.cells = np.zeros(max(1, 1 << bits >> 6), np.uint64)
        self.cells[at] = cells

    def holds(self, h: np.ndarray) -> np.ndarray:
        place = h & self.mask
        return (self.cells[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)

    def __getstate__(self):
        # Sent to every executor: a sparse one is small.
        return self.mask, compress(self.cells.tobytes(), 1)

    def __setstate__(self, state):
        self.mask, self.cells = state[0], np.frombuffer(decompress(state[1]), np.uint64)

    def places(self) -> int:
        return int(np.bitwise_count(self.cells).sum())


class Chunk:
    """Words of several texts, numbered, with the language of each."""

    def __init__(self):
        self.numbers, self.langs, self.parts, self.tags, self.size = Numbers(), {}, [], [], 0

    def add(self, lang: str, words: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.tags.append(np.full(len(words), self.langs.setdefault(lang, len(self.langs)), np.int64))
        self.size += len(words)

    def close(self, known: Bitmap | None) -> None:
        """Number all words and look up, once for each word of a language, whether it may be frequent."""
        self.ids, self.tag, self.hashes = np.concatenate(self.parts), np.concatenate(self.tags), hashes_of(list(self.numbers))
        size, own = len(self.numbers), hashes_of([x.encode() for x in self.langs])
        self.codes = self.tag * size + self.ids
        if len(own) * size <= 4 * self.size:
            used = np.arange(len(own) * size)
        else:
            used, self.codes = np.unique(self.codes, return_inverse=True)
        self.first_hashes = chain(own[used // size], [self.hashes[used % size]])
        fit = used % size > 0
        self.fit = (fit if known is None else fit & known.holds(self.first_hashes))[self.codes]

    def phrases(self, m: int, known: Bitmap | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Where phrases of m words begin whose words may be frequent, and which ``known`` may hold, and their hashes."""
        count = max(0, self.size - (m - 1))
        start = np.flatnonzero(np.logical_and.reduce([self.fit[j: j + count] for j in range(m)]))
        h = self.first_hashes[self.codes[start]]
        for j in range(1, m):
            h = chain(h, [self.hashes[self.ids[start + j]]])
        if known is not None and m > 1:
            ok = known.holds(h)
            start, h = start[ok], h[ok]
        return start, h

    def hash_counts(self, m: int, known: Bitmap | None, bits: int) -> pa.RecordBatch:
        """Phrases of m words by ``bits`` of their hash, those whose first and last m - 1 words ``known`` may hold.

        A row for each group of hashes: the low bits of those met once, and of the others with their counts.
        """
        mask = np.uint64((1 << bits) - 1)
        if m == 1:
            times = np.bincount(self.codes[self.fit], minlength=len(self.first_hashes))
            at = np.flatnonzero(times)
            h, same = np.unique(self.first_hashes[at] & mask, return_inverse=True)
            n = np.zeros(len(h), np.int64)
            np.add.at(n, same, times[at])
        else:
            start, h = self.phrases(m)
            if m > 2:
                ok = np.zeros(self.size + 1, bool)
                ok[self.phrases(m - 1, known)[0]] = True
                h = h[ok[start] & ok[start + 1]]
            h, n = np.unique(h & mask, return_counts=True)
        group, low = (h >> np.uint64(SLOTS)).astype(np.int32), (h & np.uint64((1 << SLOTS) - 1)).astype(np.uint32)
        groups, begins = np.unique(group, return_index=True)
        rows = []
        for at, end in zip(begins, np.append(begins[1:], len(h))):
            once = n[at:end] == 1
            rows.append((low[at:end][once].tobytes(), low[at:end][~once].tobytes(),
                         n[at:end][~once].astype(np.uint32).tobytes()))
        columns = zip(*rows) if rows else ([], [], [])
        return pa.RecordBatch.from_arrays([pa.array(groups, pa.int32()), *[pa.array(c, pa.binary()) for c in columns]],
                                          names=["grp", "once", "often", "n"])

    def stripes(self, m: int, known: Bitmap, hot: frozenset, groups: int) -> pa.RecordBatch:
        """The stripes of level m with the phrases that ``known`` may hold, bundled by group."""
        ids, tag, size = self.ids, self.tag, len(self.numbers)
        at, _ = self.phrases(m, known)
        pid = tag[at]
        for j in range(m - 1):
            pid = pid * size + ids[at + j]
            if j < m - 2:
                pid = np.unique(pid, return_inverse=True)[1]
        if m == 1:       # every language has the empty prefix, which tells its number of words
            lang, prefix_words = np.arange(len(self.langs)), []
        else:
            _, first, pid = np.unique(pid, return_index=True, return_inverse=True)
            lang, prefix_words = tag[at[first]], [ids[at[first] + j] for j in range(m - 1)]
        is_hot = np.zeros(size, bool)
        is_hot[[self.numbers[w] for w in hot if w in self.numbers]] = True
        dealt_out = np.logical_and.reduce([np.ones(len(lang), bool), *[is_hot[w] for w in prefix_words]])
        count = np.uint64(groups)
        group = (chain(hashes_of([x.encode() for x in self.langs])[lang], [self.hashes[w] for w in prefix_words])
                 % count).astype(np.int64)
        following = ids[at + m - 1]
        grp = np.where(dealt_out[pid], (self.hashes[following] % count).astype(np.int64), group[pid])
        # (group, prefix) pairs in order of group, each with the words that follow.
        keys, times = np.unique((grp * len(lang) + pid) * size + following, return_counts=True)
        stripe, following = keys // size, keys % size
        alone = group * len(lang) + np.arange(len(lang)) if m == 1 else stripe[:0]
        held = np.unique(np.concatenate([alone, stripe]))
        grp, prefix = held // len(lang), held % len(lang)
        total = np.zeros(len(held), np.int64)
        if m == 1:
            total[np.searchsorted(held, alone)] = np.bincount(tag[ids > 0], minlength=len(lang))
        ends = lambda values, wanted, n: pa.array(np.append(np.searchsorted(values, wanted), n).astype(np.int32))
        text = pa.array(list(self.numbers), pa.binary()).cast(pa.string())
        joined = pc.binary_join_element_wise(*[text.take(pa.array(w)) for w in prefix_words], " ") if m > 1 else pa.array(
            [""] * len(lang), pa.string())
        inner = ends(stripe, held, len(keys))
        bundles = np.unique(grp)
        outer = ends(grp, bundles, len(held))
        in_bundle = lambda values: pa.ListArray.from_arrays(outer, values)
        return pa.RecordBatch.from_arrays([
            pa.array(bundles, pa.int32()), in_bundle(pa.array(list(self.langs), pa.string()).take(pa.array(lang[prefix]))),
            in_bundle(joined.take(pa.array(prefix))), in_bundle(pa.array(total)),
            in_bundle(pa.ListArray.from_arrays(inner, text.take(pa.array(following)))),
            in_bundle(pa.ListArray.from_arrays(inner, pa.array(times, pa.int64())))],
            names=["grp", "lang", "prefix", "total", "next", "n"])

    def pairs_only(self, known: Bitmap) -> pa.RecordBatch:
        """A text for each language: the words in pairs that ``known`` may hold, a full stop for those left out."""
        start, _ = self.phrases(2, known)
        kept = np.zeros(self.size + 1, bool)
        kept[start] = kept[start + 1] = True
        kept = kept[:-1]
        first_left_out = np.zeros(self.size, bool)
        first_left_out[1:] = kept[:-1] & ~kept[1:]
        words, texts, shown = list(self.numbers), [], np.where(kept, self.ids, 0)
        for k in range(len(self.langs)):
            texts.append(b" ".join([words[w] for w in shown[(self.tag == k) & (kept | first_left_out)]]))
        return pa.RecordBatch.from_arrays([pa.array(list(self.langs), pa.string()), pa.array(texts, pa.binary())],
                                          names=["lang", "text"])


def _by_chunk(texts: DataFrame, schema: str, settings: Settings, words: Broadcast, of) -> DataFrame:
    """What ``of(chunk)`` gives for every chunk of words of a task; ``words`` tells which may be frequent."""
    def run(batches):
        chunk = Chunk()
        for batch in batches:
            for lang, text in rows_of(batch):
                for part in words_of(text, settings.part):
                    chunk.add(lang, part)
                    if chunk.size >= settings.chunk:
                        chunk.close(words.value)
                        yield from slices(of(chunk), 1 << 14)
                        chunk = Chunk()
        if chunk.size:
            chunk.close(words.value)
            yield from slices(of(chunk), 1 << 14)

    return arrow_map(texts, run, schema)


def _bitmap(texts: DataFrame, m: int, words: Broadcast, known: Broadcast, settings: Settings,
            hash_bits: int) -> Bitmap | None:
    """Bitmap of the hashes of m words that reach ``least``; None if there is none."""
    bits = min(settings.bits, hash_bits)
    counts = _by_chunk(texts, COUNTS, settings, words, lambda chunk: chunk.hash_counts(m, known.value, hash_bits))

    def add(batches):
        total, group = np.zeros(1 << SLOTS, np.int64), None

        def reached():
            at = np.flatnonzero(total >= settings.least)
            return pa.RecordBatch.from_arrays([pa.array(at + (group << SLOTS), pa.int64())], names=["h"])

        for batch in batches:
            for own, once, often, n in rows_of(batch):
                if own != group:
                    if group is not None:
                        yield reached()
                        total[:] = 0
                    group = own
                # The hashes of a row differ, so none is lost here.
                total[np.frombuffer(once, np.uint32)] += 1
                total[np.frombuffer(often, np.uint32)] += np.frombuffer(n, np.uint32)
        if group is not None:
            yield reached()

    often = arrow_map(counts.repartition("grp").sortWithinPartitions("grp"), add, "h long")
    low = F.col("h").bitwiseAND(F.lit((1 << bits) - 1))
    # A shift takes its distance from the value, hence the expression. At most 2**(bits - 6) rows.
    cells = often.select(F.shiftright(low, 6).alias("at"), F.expr("shiftleft(1L, int(h & 63))").alias("bit"))
    found = cells.groupBy("at").agg(F.bit_or("bit").alias("cell")).toArrow()
    if not found.num_rows:
        return None
    return Bitmap(bits, found["at"].to_numpy(), found["cell"].to_numpy().view(np.uint64))


def _merged(texts: DataFrame, m: int, words: Broadcast, known: Broadcast, hot: frozenset, groups: int,
            settings: Settings) -> DataFrame:
    """The stripes of level m, those of a group added element by element; entries of ``least`` and more."""
    bundles = _by_chunk(texts, BUNDLE, settings, words, lambda chunk: chunk.stripes(m, known.value, hot, groups))
    schema = arrow_schema(texts.sparkSession, STRIPES)

    def closed(found: dict) -> pa.RecordBatch | None:
        rows = []
        for (lang, prefix), (total, entries) in found.items():
            kept = {w: k for w, k in entries.items() if k >= settings.least}
            if kept or total:
                rows.append((lang, prefix, total, list(kept), list(kept.values())))
        columns = zip(*rows) if rows else [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def merge(batches):
        found, group = {}, None
        for batch in batches:
            for row in range(batch.num_rows):
                own, *bundle = (c[0].as_py() for c in batch.slice(row, 1).columns)
                if own != group:
                    yield closed(found)
                    found, group = {}, own
                for lang, prefix, count, following, times in zip(*bundle):
                    total, entries = found.setdefault((lang, prefix), (0, {}))
                    found[lang, prefix] = (total + count, entries)
                    for w, k in zip(following, times):
                        entries[w] = entries.get(w, 0) + k
        yield closed(found)

    return arrow_map(bundles.repartition("grp").sortWithinPartitions("grp"), merge, STRIPES)


def stripes(docs: DataFrame, settings: Settings = Settings()) -> list[DataFrame]:
    """The merged stripes of levels 1, 2 ... as written tables, up to the last level with a frequent phrase."""
    texts = docs.select(F.coalesce(F.col("lang"), F.lit(UNKNOWN)).alias("lang"), F.col("text").cast("binary").alias("text"))
    send = docs.sparkSession.sparkContext.broadcast
    levels, words, known, hot, bits = [], send(None), send(None), frozenset(), settings.hash_bits
    for m in range(1, settings.longest + 1):
        found = _bitmap(texts, m, words, known, settings, bits)
        if found is None:
            break
        if m > 2:
            known.unpersist()
        known = send(found)
        words = known if m == 1 else words
        if m == 2:
            texts = written(_by_chunk(texts, "lang string, text binary", settings, words,
                                      lambda chunk, pairs=known: chunk.pairs_only(pairs.value)), "pairs")
        groups = found.places() // settings.group + 64
        levels.append(written(_merged(texts, m, words, known, hot, groups, settings), f"stripes-{m}"))
        if m == 1:
            all_words = levels[0].agg(F.sum("total")).first()[0]
            hot, bits = _hot_words(levels[0], all_words, settings), max(bits, min(MOST_BITS, all_words.bit_length() + 3))
    return levels


def _hot_words(words: DataFrame, all_words: int, settings: Settings) -> frozenset:
    """Words that make up 1 / ``hot`` of all words in some language together: at most ``hot``."""
    counts = words.select(F.explode(F.arrays_zip("next", "n")).alias("e")).groupBy("e.next").agg(F.sum("e.n").alias("k"))
    rows = counts.where(F.col("k") * settings.hot >= all_words).collect()
    return frozenset(r[0].encode() for r in rows)


def collocations(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's best phrases; see the module."""
    levels = stripes(docs, settings)
    if len(levels) < 2:
        return docs.sparkSession.createDataFrame([], RESULT)
    tables = levels[0]
    for level in levels[1:]:
        tables = tables.unionByName(level)
    phrase = lambda prefix, word: F.when(prefix == "", word).otherwise(F.concat_ws(" ", prefix, word))
    entries = tables.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("e")).select(
        "lang", "prefix", phrase(F.col("prefix"), F.col("e.next")).alias("phrase"), F.col("e.n").alias("a"))
    longer = entries.where(F.col("prefix") != "")
    parts = entries.select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    sizes = levels[0].groupBy("lang").agg(F.sum("total").alias("n"))

    # The most frequent extension: by a stripe's largest entry, and by the entries that end in the phrase.
    to_right = longer.select("lang", F.col("prefix").alias("phrase"), "a")
    to_left = longer.select("lang", F.regexp_replace("phrase", "^[^ ]* ", "").alias("phrase"), "a")
    covers = to_right.unionByName(to_left).groupBy("lang", "phrase").agg(F.max("a").alias("cover"))
    open_ = longer.join(covers, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("cover") < settings.share * F.col("a"), F.lit(True))).select("lang", "phrase", "a")

    words = F.split("phrase", " ")
    cut = lambda start, length: F.array_join(F.slice(words, start, length), " ")
    cuts = open_.select("lang", "phrase", "a", F.explode(F.sequence(F.lit(1), F.size(words) - 1)).alias("k")).select(
        "*", cut(F.lit(1), F.col("k")).alias("first"), cut(F.col("k") + 1, F.size(words)).alias("rest"))
    left, right = (parts.select("lang", F.col("part").alias(c), F.col("f").alias(f)) for c, f in (("first", "l"), ("rest", "r")))
    sized = cuts.join(left, ["lang", "first"]).join(right, ["lang", "rest"]).join(sizes, "lang")
    big = lambda c: f"CAST({c} AS DECIMAL(19, 0))"
    score = F.expr(f"({big('1000 * a')} * {big('n')}) DIV ({big('l')} * {big('r')})")
    best = sized.withColumn("score", score).groupBy("lang", "phrase", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    scored = best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    # A hot language is cut down in parts before its best phrases meet in one task.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    spread = F.pmod(F.xxhash64("phrase"), F.lit(64))
    for by in (["lang", spread], ["lang"]):
        scored = scored.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
            F.col("rank") <= settings.top)
    return scored.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
