"""License scans by diagonal voting, with Spark expressions only.

Every text is cut into words; each pair of neighbouring words is hashed and
joined to the positions of the same pair in the templates. A hit at word p of
a text and pair q of a template votes for the diagonal p - q, where the
template would start. Votes are gathered as a bit mask of template pairs, so
repeated rows and repeated hits count once. Diagonals of one template that
lie within ``MERGE`` words of each other are merged (inserted or missing
words), and a span is verified if it covers ``COVERED`` of the template's
pairs within ``STRETCH`` times its length. Base phrases must stand word for
word, so their diagonals are never merged and must be covered in full.

Only texts' ids, hashes and hits are shuffled, aggregated per diagonal before
that; the templates are a constant of this module, hence the broadcast.

Defined cases: a null or empty text has no words and no labels, null first and
last word and score 0; rows that repeat give one result each; a null doc_id is
a key like any other; other columns are ignored; a text is one row, and what
one task orders is the hits of one text with one template.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shiftline.llm.common import constant

# The base phrases, and license lines as they are usually written.
BASE = [("mit", "mit license"), ("apache", "apache license"), ("gpl", "general public license")]
LINES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify"),
    ("lgpl", "gnu lesser general public license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "creative commons attribution 4 0 international license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("mpl", "mozilla public license version 2 0"),
]
MERGE = 2
COVERED = 0.8
STRETCH = 1.5
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of the text with A-Z in lower case.

    ``lower`` also changes other letters, which neither moves a word's limits
    nor makes an ASCII letter, but for the Kelvin sign; that is put aside.
    """
    return F.regexp_extract_all(
        F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("Ⓚ"))),
        F.lit(WORD), F.lit(0))


def templates(spark: SparkSession) -> DataFrame:
    """One row per template pair: t, label, base, pairs, at, bit, first, second, lead, gram."""
    rows, seen = [], set()
    for t, (label, line) in enumerate(BASE + LINES):
        own = line.split(" ")
        for at, pair in enumerate(zip(own, own[1:])):
            rows.append((t, label, t < len(BASE), len(own) - 1, at, 1 << at, *pair, pair not in seen))
            seen.add(pair)
    return constant(spark, "t label base pairs at bit first second lead", rows).withColumns(
        {"bit": F.col("bit").cast("long"), "gram": F.xxhash64("first", "second")})


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score per row."""
    cut = docs.select("doc_id", F.xxhash64("text").alias("h"), words(F.col("text")).alias("w"))
    pairs = cut.select(
        "doc_id", "h", F.size("w").cast("long").alias("n_words"),
        F.posexplode_outer(F.arrays_zip(F.col("w").alias("a"), F.slice("w", 2, F.greatest(
            F.size("w"), F.lit(1))).alias("b"))).alias("p", "g")).select(
        "doc_id", "h", "n_words", "p", F.col("g.a").alias("a"), F.col("g.b").alias("b"))
    hits = pairs.join(
        F.broadcast(templates(docs.sparkSession)),
        (F.xxhash64("a", "b") == F.col("gram")) & (F.col("a") == F.col("first"))
        & (F.col("b") == F.col("second")), "left")
    # The first word's row also stands for its text: once, however many pairs it hits.
    stands = (F.coalesce(F.col("p"), F.lit(0)) == 0) & F.coalesce(F.col("lead"), F.lit(True))
    row = ["doc_id", "h", "n_words"]
    votes = hits.where(F.col("t").isNotNull() | stands).select(
        *row, "t", "label", "base", "pairs", "p", (F.col("p") - F.col("at")).alias("diagonal"),
        "bit", stands.alias("stands"))
    template = ["t", "label", "base", "pairs"]
    diagonals = votes.groupBy(*row, *template, "diagonal").agg(
        F.bit_or("bit").alias("mask"), F.min("p").alias("lo"), F.max("p").alias("hi"),
        F.count_if("stands").alias("copies"))
    along = Window.partitionBy("doc_id", "h", "t").orderBy("diagonal")
    apart = F.col("diagonal") - F.lag("diagonal").over(along) > MERGE
    spans = diagonals.withColumn(
        "opens", (F.col("base") | F.coalesce(apart, F.lit(True))).cast("int")).withColumn(
        "span", F.sum("opens").over(along)).groupBy(*row, *template, "span").agg(
        F.bit_or("mask").alias("mask"), (F.max("hi") - F.min("lo") + 1).alias("length"),
        F.min("diagonal").alias("start"), F.sum("copies").alias("copies"))
    covered = F.bit_count("mask") / F.col("pairs")
    verified = F.when(F.col("base"), covered == 1).otherwise(
        (covered >= COVERED) & (F.col("length") <= STRETCH * F.col("pairs")))
    judged = spans.withColumns({"covered": covered, "found": F.coalesce(verified, F.lit(False))})
    base = F.col("found") & F.col("base")
    labels = lambda where: F.array_join(F.array_sort(F.collect_set(F.when(where, F.col("label")))), ",")
    return judged.groupBy(*row).agg(
        F.count_if(base).alias("n_base"), F.min(F.when(base, F.col("start"))).cast("long").alias("first_word"),
        F.max(F.when(base, F.col("start"))).cast("long").alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("found")).alias("labels"),
        F.coalesce(F.max("covered"), F.lit(0.0)).alias("score"), F.sum("copies").alias("copies")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score",
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")).drop("copy")
