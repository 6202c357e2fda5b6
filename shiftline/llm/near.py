"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct word shingles, as 64-bit hashes. Its sketch
has ``REGISTERS`` registers: a shingle's hash picks one and competes there
for the smallest value, of which the register keeps the number of leading
zeros and the next ``MANTISSA`` bits. Registers that a small set leaves empty
are filled by further rounds of hashing, an earlier round always winning, so
equal registers remain as likely as the sets are similar at any size.

1. Equal sets form a class; all that follows works on one member of each.
2. ``BANDS`` groups of ``ROWS`` registers are hashed; sets that share a band
   are candidates (at similarity 0.85 all bands differ with a chance of
   1e-6). Each band bucket ties its members to its smallest one, and the
   connected components of these ties hold every candidate pair.
3. A component is split into blocks of at most about ``BLOCK_SETS`` sets.
   Each block is compared with itself and with the component's first block,
   inside a task: the collision-corrected estimate of the similarity first,
   then the full sets, skipping what is already linked. A block only returns
   links that join something new.
4. In components of several blocks that are not one group yet, the sets
   outside the largest group are compared with all blocks in the same way.
5. Links and classes give the connected components.

No pair is ever a row: rows grow with documents, plus, for very large loose
components only, (sets outside the largest group / ``BLOCK_SETS``) copies of
that component's sets.

Defined cases: a null text, or one without words, has the empty set and is
linked with nothing; with fewer words than ``SHINGLE`` the whole sequence is
the one shingle. Rows that share an id are one document: whatever their texts
are linked with is linked, and all of them have its component. A row without
an id has a component only if an equal set or a link brings in an id, and is
kept otherwise; a class without any id is known by its text's smallest 64-bit
hash. Ties do not occur, as all choices are minima; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm import hashing
from shiftline.llm.common import arrow_map, arrow_schema, fresh, map_rows, rows_of, written
from shiftline.llm.graph import components

SHINGLE = 5
SIMILAR = 85  # per cent
REGISTERS = 256
MANTISSA = 10
BANDS, ROWS = 36, 7
#: Pairs estimated below this are not verified: 4.5 standard errors under 0.85.
LEAST_ESTIMATE = 0.75
BLOCK_SETS = 512
BLOCK_SHINGLES = 1 << 21
#: Ids that a join may broadcast (8 bytes each); more are shuffled.
BROADCAST_IDS = 1_000_000
#: Rounds of hashing before every shingle goes to every register still empty.
ROUNDS = 200

U = np.uint64
# ASCII white space.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles, A-Z in lower case."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
    space = SPACE[data]
    words = []
    for start, end in hashing.blocks(space):
        starts, ends = hashing.word_limits(space[start:end])
        words.append(hashing.hash_words(data[start:end], starts, ends))
    if not words:
        return np.zeros(0, U)
    return np.unique(hashing.shingles(np.concatenate(words), SHINGLE))


def registers(shingles: np.ndarray) -> np.ndarray:
    """The sketch of a non-empty set: leading zeros and mantissa of each register, uint16."""
    best = np.full(REGISTERS, 0xFFFFFFFFFFFFFFFF, U)
    done = 0
    while done < ROUNDS:
        rounds = min(max(1, 1400 // len(shingles)), ROUNDS - done)
        seeds = np.arange(done, done + rounds, dtype=U)
        hashes = hashing.mix(shingles[None, :] ^ hashing.mix(seeds + U(1))[:, None])
        keys = (seeds[:, None] << U(56)) | (hashes >> U(8))
        np.minimum.at(best, (hashes & U(REGISTERS - 1)).astype(np.intp).ravel(), keys.ravel())
        done += rounds
        if best.max() != U(0xFFFFFFFFFFFFFFFF):
            break
    for k in np.flatnonzero(best == U(0xFFFFFFFFFFFFFFFF)):
        best[k] = U(ROUNDS << 56) | (hashing.mix(shingles ^ hashing.mix(U(ROUNDS) + k.astype(U)[None])).min() >> U(8))
    value = best & U((1 << 56) - 1)
    length = np.frexp(value.astype(np.float64))[1].astype(np.int64)
    shift = length - 1 - MANTISSA
    bits = np.where(shift >= 0, value >> np.maximum(shift, 0).astype(U), value << np.maximum(-shift, 0).astype(U))
    zeros = np.clip(56 - length, 0, 56).astype(U)
    return ((zeros << U(MANTISSA)) | (bits & U((1 << MANTISSA) - 1))).astype(np.uint16)


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """One 64-bit key for each band of registers."""
    rows = sketch[: BANDS * ROWS].reshape(BANDS, ROWS).astype(U)
    key = np.arange(1, BANDS + 1, dtype=U)
    for j in range(ROWS):
        key = hashing.mix(key * hashing.STEP + rows[:, j])
    return key


def estimates(sketches: np.ndarray, one: int) -> np.ndarray:
    """Estimated similarity of sketch ``one`` with each sketch.

    Two different minima give the same register if their zeros agree, which
    the sketches' own zeros say how often, and their mantissas do.
    """
    zeros = sketches >> MANTISSA
    same = (sketches == sketches[one]).mean(axis=1)
    share = np.bincount(zeros[one], minlength=64) / REGISTERS
    chance = share[zeros].mean(axis=1) / (1 << MANTISSA)
    return (same - chance) / (1 - chance)


def sketch_documents(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, n_shingles, digest, bands of every row; the last two null for an empty set."""
    def row(doc_id, text_hash, text):
        shingles = shingle_set(text)
        if not len(shingles):
            return doc_id, text_hash, 0, None, None
        return (doc_id, text_hash, len(shingles), xxhash.xxh3_128_digest(shingles.tobytes()),
                band_keys(registers(shingles)).view(np.int64))
    return map_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                F.xxhash64("text").alias("text_hash"), "text"), row,
                    "doc_id long, text_hash long, n_shingles long, digest binary, bands array<long>")


def candidate_components(classes: DataFrame) -> DataFrame:
    """node, label: components of sets that share band buckets."""
    keyed = classes.select("node", F.explode("bands").alias("key"))
    shared = keyed.groupBy("key").agg(F.min("node").alias("hub"), F.count(F.lit(1)).alias("n")).where(
        F.col("n") > 1).drop("n")
    ties = keyed.join(shared, "key").where(F.col("node") != F.col("hub")).select(
        F.col("node").alias("a"), F.col("hub").alias("b"))
    return components(ties)


def _only(docs: DataFrame, nodes: DataFrame, n: int) -> DataFrame:
    """Rows of docs whose id is among the n nodes, with the nodes' columns."""
    nodes = nodes.withColumnRenamed("node", "doc_id")
    return docs.join(F.broadcast(nodes) if n <= BROADCAST_IDS else nodes, "doc_id")


def _texts(docs: DataFrame, members: DataFrame, n: int, nameless: bool) -> DataFrame:
    """doc_id, text; if ``nameless``, also one row of each text without an id that is a member, by its hash."""
    named = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not nameless:
        return named
    hashed = named.where(F.col("doc_id").isNull()).select(F.xxhash64("text").alias("doc_id"), "text")
    some = _only(hashed, members.select("node").distinct(), n)
    return named.where(F.col("doc_id").isNotNull()).unionByName(
        some.groupBy("doc_id").agg(F.first("text").alias("text")))


def verified_links(docs: DataFrame, members: DataFrame, n: int, within: bool, nameless: bool = False) -> DataFrame:
    """Links (a, b) found inside groups.

    ``members``: node, digest, grp, places array<struct<place, first>>, one
    entry for each group that gets the node's set. Sets marked ``first`` are
    compared with the others and, if ``within``, among themselves.
    """
    schema = "node long, grp long, places array<struct<place: long, first: boolean>>, joined long, shingles binary, sketch binary"
    text = _only(_texts(docs, members, n, nameless), members, n).select(
        "doc_id", "grp", "places", "joined", "digest", "text")
    arrow = arrow_schema(docs.sparkSession, schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, grp, places, joined, digest, body in rows_of(batch):
                shingles = shingle_set(body)
                if xxhash.xxh3_128_digest(shingles.tobytes()) == digest:
                    rows.append((doc_id, grp, places, joined, shingles.tobytes(), registers(shingles).tobytes()))
            columns = zip(*rows) if rows else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    sets = arrow_map(text, read, schema).select(
        "grp", F.inline("places"), "node", "joined", "shingles", "sketch")
    dealt = sets.repartition("grp", "place").sortWithinPartitions("grp", "place", "node", "shingles").select(
        "grp", "place", "first", "node", "joined", "shingles", "sketch")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, key = [], None
        for batch in batches:
            for row in rows_of(batch):
                if row[:2] != key:
                    yield from _emit(_links(group, within))
                    group, key = [], row[:2]
                group.append(row[2:])
        yield from _emit(_links(group, within))

    return arrow_map(dealt, compare, "a long, b long")


def _emit(links: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if links:
        a, b = zip(*links)
        yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _links(group: list[tuple], within: bool) -> list[tuple[int, int]]:
    """Links of a group that join sets not joined before: (first, node, joined, set, sketch) rows."""
    if len(group) < 2:
        return []
    first = np.array([g[0] for g in group])
    sets = [np.frombuffer(g[3], U) for g in group]
    sizes = np.array([len(s) for s in sets])
    sketches = np.stack([np.frombuffer(g[4], np.uint16) for g in group])
    pairs = []
    for i in np.flatnonzero(first):
        likely = estimates(sketches, i)
        ok = (likely >= LEAST_ESTIMATE) & (100 * np.minimum(sizes, sizes[i]) >= SIMILAR * np.maximum(sizes, sizes[i]))
        if within:
            ok[:i] &= ~first[:i]
        else:
            ok &= ~first
        ok[i] = False
        pairs += [(-likely[j], i, j) for j in np.flatnonzero(ok)]
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for _, i, j in sorted(pairs):
        a, b = root(group[i][2]), root(group[j][2])
        if a == b:
            continue
        common = sizes[i] + sizes[j] - len(np.union1d(sets[i], sets[j]))
        if 100 * common >= SIMILAR * (sizes[i] + sizes[j] - common):
            parent[max(a, b)] = min(a, b)
            out.append((group[i][1], group[j][1]))
    return out


def link(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs``."""
    return _linked(docs).drop("text_hash")


def _linked(docs: DataFrame) -> DataFrame:
    sketched = written(sketch_documents(docs), "sketches")
    classes = written(sketched.where(F.col("digest").isNotNull()).groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.coalesce(F.min("doc_id"), F.min("text_hash")).alias("node"),
        F.first("n_shingles").alias("n"), F.first("bands").alias("bands")), "classes")
    nameless = not classes.where(F.col("id").isNull()).isEmpty()
    loose = candidate_components(classes)
    labelled = written(loose.join(classes.select("node", "n", "digest"), "node"), "labelled")
    # Sizes come from an aggregation, not a window: one component may hold a third of the sets.
    sizes = labelled.groupBy("label").agg(F.greatest(
        F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    members = written(labelled.join(sizes, "label").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks"))), "members")
    n = members.count()
    place = lambda at, first: F.struct(at.cast("long").alias("place"), F.lit(first).alias("first"))
    others = F.when((F.col("block") == 0) & (F.col("blocks") > 1), F.transform(
        F.sequence(F.lit(1).cast("long"), F.col("blocks") - 1), lambda k: place(k, False)))
    dealt = members.select(
        "node", "digest", F.col("label").alias("grp"), F.col("node").alias("joined"),
        F.concat(F.array(place(F.col("block"), True)), F.coalesce(
            others, F.array().cast("array<struct<place: bigint, first: boolean>>"))).alias("places"))
    links = written(verified_links(docs, dealt, n, True, nameless), "links")
    # Ids with more than one set tie their classes; the hash of a null digest stands for the empty set.
    several = sketched.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.min(F.xxhash64("digest")).alias("low"), F.max(F.xxhash64("digest")).alias("high")).where(
        F.col("low") != F.col("high")).select("doc_id")
    shared = written(sketched.join(several, "doc_id", "left_semi").select("doc_id", "digest").distinct().join(
        classes.select("digest", "node"), "digest").select(F.col("node").alias("a"), F.col("doc_id").alias("b")), "shared")
    links = links.unionByName(shared)
    groups = components(links)
    split = members.where(F.col("blocks") > 1)
    if not split.isEmpty():
        links = written(links.unionByName(_outside(docs, split, groups, nameless)), "links")
        groups = components(links)
    groups = groups.withColumnRenamed("label", "component")
    if nameless:                                    # a group goes by its smallest id, not by a text's hash
        names = classes.where(F.col("id").isNotNull()).select("node").distinct().join(groups, "node").groupBy(
            "component").agg(F.min("node").alias("name"))
        groups = groups.join(names, "component", "left").select("node", F.col("name").alias("component"))
    ids = classes.select("digest", "id", "node").join(groups, "node", "left").select(
        "digest", F.coalesce("component", "id").alias("component"))
    found = sketched.select("doc_id", "text_hash", "n_shingles", "digest").join(ids, "digest", "left")
    if not shared.isEmpty():                        # a row of the empty set goes with its id's other rows
        own = shared.select(F.col("b").alias("node")).distinct().join(groups, "node", "left").select(
            F.col("node").alias("doc_id"), F.coalesce("component", "node").alias("own"))
        found = found.join(own, "doc_id", "left").withColumn("component", F.coalesce("own", "component"))
    return found.select(
        "doc_id", "text_hash", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _outside(docs: DataFrame, split: DataFrame, groups: DataFrame, nameless: bool) -> DataFrame:
    """Links of the sets outside the largest group of their component, with all its sets."""
    grouped = split.join(groups.withColumnRenamed("label", "joined"), "node", "left").withColumn(
        "joined", F.coalesce("joined", "node"))
    sizes = grouped.groupBy("label", "joined").agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("s"))
    main = sizes.groupBy("label").agg(
        F.max(F.struct("k", "joined"))["joined"].alias("main"), F.sum("k").alias("all_k"), F.sum("s").alias("all_s"),
        F.max(F.struct("k", "s"))["k"].alias("main_k"), F.max(F.struct("k", "joined", "s"))["s"].alias("main_s"))
    parts = F.greatest(F.ceil((F.col("all_k") - F.col("main_k")) / BLOCK_SETS),
                       F.ceil((F.col("all_s") - F.col("main_s")) / BLOCK_SHINGLES)).cast("long")
    todo = written(grouped.join(main.withColumn("parts", parts).select("label", "main", "parts"), "label").where(
        F.col("parts") > 0), "outside")
    # Place: block * parts + part. A set stands in its block for every part, and
    # one outside the largest group also in its part for every block.
    upto = lambda c: F.sequence(F.lit(0).cast("long"), F.col(c) - 1)
    place = lambda at, first: F.struct(at.cast("long").alias("place"), F.lit(first).alias("first"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    stands = F.transform(upto("parts"), lambda t: place(F.col("block") * F.col("parts") + t, False))
    visits = F.when(F.col("joined") != F.col("main"), F.transform(
        upto("blocks"), lambda b: place(b * F.col("parts") + part, True)))
    dealt = todo.select("node", "digest", F.col("label").alias("grp"), "joined", F.concat(
        stands, F.coalesce(visits, F.array().cast("array<struct<place: bigint, first: boolean>>"))).alias("places"))
    return verified_links(docs, dealt, todo.count(), False, nameless)


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each component, all columns unchanged: the one with its smallest id.

    Of rows that share that id, or have none, one for each id or text stays.
    """
    dropped = written(_linked(docs).where(~F.col("kept")).select(
        "doc_id", F.when(F.col("doc_id").isNull(), F.col("text_hash")).alias("text_hash")).distinct(), "dropped")
    few = dropped.count() <= BROADCAST_IDS
    ids = dropped.where(F.col("doc_id").isNotNull())
    left = docs.join(F.broadcast(ids) if few else ids, docs["doc_id"] == ids["doc_id"], "left_anti")
    nameless = dropped.where(F.col("doc_id").isNull())
    if not nameless.isEmpty():                      # rows without an id go by their text
        left = left.join(F.broadcast(nameless) if few else nameless, docs["doc_id"].isNull() & (
            F.xxhash64(docs["text"]) == nameless["text_hash"]), "left_anti")
    repeated = written(left.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(
        (F.col("n") > 1) | F.col("doc_id").isNull()).select("doc_id"), "repeated")
    if repeated.isEmpty():
        return left
    is_repeated = left["doc_id"].eqNullSafe(repeated["doc_id"])
    place = fresh(docs, "place")
    same = Window.partitionBy("doc_id", F.when(F.col("doc_id").isNull(), F.xxhash64("text"))).orderBy(
        F.xxhash64("text"), "text")
    first = left.join(repeated, is_repeated, "left_semi").withColumn(
        place, F.row_number().over(same)).where(F.col(place) == 1).drop(place)
    return left.join(repeated, is_repeated, "left_anti").unionByName(first)
