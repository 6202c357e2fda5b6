"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Sources sorted by code point (null last) weigh 5, 2, 1, repeating, and
   share all words. A target stops at ``MAX_REPEATS`` times its source's size
   and the excess is shared again by weight (water filling).
2. Blocks of ``BLOCK_WORDS`` words are the seats: sources get them by the
   highest quotients target / (2k - 1), and each source's blocks go to its
   shards the same way, by shard size. That gives an integer quota per shard.
3. Inside a shard the documents stand in a seeded order, end to end; the quota
   is taken from that order's start, as often round as it needs.

Only (doc_id, source, size) is shuffled. A source has one shard per
``SHARD_WORDS`` words, so a hot source is spread over many tasks; what is
ordered in one task is one shard, or the table of sources.

Defined cases: a null or empty text has size 0 and is taken 0 times; null is a
source of its own, the last; rows that repeat count each on their own and
equal rows are interchangeable; ties of quotients go to the first source or
shard; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftline.llm.common import fresh, written

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 64
SHARD_WORDS = 1 << 20
SEED = 42
WORD = r"[^\x20\x09-\x0D]+"


def size_of(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size -> and target: weighted shares of all words, capped.

    With the sources in order of cap / weight, the level at a source is what
    the words not yet bound give per unit of the weights left. The first
    source whose own level is under its cap per weight sets the level for all
    that follow; those before it sit at their caps.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sources.withColumn("rank", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.get(F.array(*map(F.lit, WEIGHTS)), F.col("rank") % len(WEIGHTS)))
    capped = ranked.withColumn("cap", F.lit(MAX_REPEATS) * F.col("source_size"))
    before = Window.orderBy(F.col("cap") / F.col("weight"), "rank").rowsBetween(
        Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    bound = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    levels = capped.select(
        "source", "source_size", "rank", "weight", "cap",
        ((F.sum("source_size").over(whole) - bound("cap"))
         / (F.sum("weight").over(whole) - bound("weight"))).alias("level"))
    ratio = F.col("cap") / F.col("weight")
    first_open = F.when(F.col("level") <= ratio, F.struct(ratio, F.col("rank")))
    level = F.min_by("level", first_open).over(whole)
    return levels.withColumn("common", level).select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"),
                F.coalesce(F.col("weight") * F.col("common"), F.col("cap").cast("double")))
        .alias("target"))


def sainte_lague(parties: DataFrame, group: list[str], party: list[str], votes: str,
                 seats: str) -> DataFrame:
    """group and party columns with ``quota``: the seats of each group by highest quotients.

    ``seats`` is the group's number of seats. Rounding votes / (votes per
    seat) misses that number by at most half a seat a party, and the seats
    that then change hands are among the next few quotients of each party, so
    only those are ranked: about three rows a party in all.
    """
    over = Window.partitionBy(*group)
    rounded = parties.withColumn("all_votes", F.sum(votes).over(over)).withColumn(
        "near", F.coalesce(F.floor(F.try_divide(F.col(votes).cast("double") * F.col(seats), F.col("all_votes"))
                                   + 0.5), F.lit(0)).cast("long"))
    missing = F.abs(F.col(seats) - F.sum("near").over(over)) + F.count(F.lit(1)).over(over)
    spread = rounded.withColumn("missing", missing).withColumn(
        "reach", (F.ceil(F.coalesce(F.try_divide(F.col(votes).cast("double") * F.col("missing"),
                                                 F.col("all_votes")), F.lit(0))) + 1).cast("long")
    ).withColumn("sure", F.greatest(F.col("near") - F.col("reach"), F.lit(0).cast("long")))
    ranked = spread.withColumn("left", F.col(seats) - F.sum("sure").over(over)).withColumn(
        "seat", F.explode(F.sequence(F.col("sure") + 1, F.col("near") + F.col("reach"))))
    quotient = F.col(votes) / (2 * F.col("seat") - 1)
    best = Window.partitionBy(*group).orderBy(quotient.desc(), *[F.col(c).asc_nulls_last() for c in party])
    won = F.sum((F.col("place") <= F.col("left")).cast("long"))
    return (ranked.where(F.col(votes) > 0).withColumn("place", F.row_number().over(best))
            .groupBy(*group, *[c for c in party if c not in group], "sure")
            .agg(won.alias("won")).withColumn("quota", F.col("sure") + F.col("won"))
            .drop("sure", "won"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken, source, text_hash of every row of ``docs``."""
    sized = written(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"),
                                F.xxhash64("text").alias("text_hash")), "sizes")
    sources = written(
        targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn(
            "shards", F.ceil((F.col("source_size") + 1) / SHARD_WORDS)), "targets")
    placed = sized.alias("d").join(
        sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*", "s.source_size", "s.target",
        F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "text_hash"), F.col("shards")).alias("shard"))
    all_seats = sources.withColumn(
        "seats", F.round(F.sum("source_size").over(Window.partitionBy()) / BLOCK_WORDS).cast("long"))
    seats = sainte_lague(all_seats.withColumn("all", F.lit(0)), ["all"], ["source"], "target",
                         "seats").select("source", F.col("quota").alias("seats"))
    shards = placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"))
    held = shards.alias("h").join(
        seats.alias("q"), F.col("h.source").eqNullSafe(F.col("q.source"))).select("h.*", "q.seats")
    quotas = sainte_lague(held, ["source"], ["source", "shard"], "shard_size", "seats")
    quota = held.alias("h").join(
        quotas.alias("q"), F.col("h.source").eqNullSafe(F.col("q.source"))
        & (F.col("h.shard") == F.col("q.shard"))).select("h.source", "h.shard", "h.shard_size", "q.quota")
    dealt = placed.alias("d").join(
        quota.alias("q"), F.col("d.source").eqNullSafe(F.col("q.source"))
        & (F.col("d.shard") == F.col("q.shard")), "left").select(
        "d.*", F.coalesce("q.shard_size", F.lit(0)).alias("shard_size"),
        F.least(F.coalesce("q.quota", F.lit(0)) * BLOCK_WORDS,
                MAX_REPEATS * F.coalesce("q.shard_size", F.lit(0))).alias("words"))
    seeded = Window.partitionBy("source", "shard").orderBy(
        F.xxhash64("doc_id", "text_hash", F.lit(SEED)), "doc_id", "text_hash").rowsBetween(Window.unboundedPreceding, -1)
    rounds = F.when(F.col("shard_size") > 0, F.floor(F.col("words") / F.col("shard_size"))).otherwise(0)
    rest = F.col("words") - F.col("rounds") * F.col("shard_size")
    return dealt.withColumn("rounds", rounds.cast("long")).withColumn(
        "start", F.coalesce(F.sum("size").over(seeded), F.lit(0))).select(
        "doc_id", "size", "source_size", "target",
        (F.col("rounds") * F.col("size")
         + F.greatest(F.least(rest - F.col("start"), F.col("size")), F.lit(0))).cast("long").alias("taken"),
        "source", "text_hash")


def apply_mix(docs: DataFrame) -> DataFrame:
    """``docs`` as the mix takes them, all columns unchanged.

    A document stands as many times as its taken words hold its size, rounded
    half up: whole documents only, so at most one a shard differs from
    ``mix``. Rows equal in id and text share their copies evenly, rounded.
    """
    copies, h, n = fresh(docs, "copies"), fresh(docs, "text_hash"), fresh(docs, "copy")
    taken = mix(docs).where(F.col("size") > 0).groupBy("doc_id", "text_hash").agg(
        F.floor(F.sum("taken") / F.sum("size") + 0.5).cast("int").alias(copies)).where(F.col(copies) > 0)
    keyed = docs.withColumn(h, F.xxhash64("text"))
    kept = keyed.join(taken, keyed["doc_id"].eqNullSafe(taken["doc_id"]) & (keyed[h] == taken["text_hash"]))
    return kept.select(*[keyed[c] for c in docs.columns], F.explode(
        F.sequence(F.lit(1), F.col(copies))).alias(n)).drop(n)
