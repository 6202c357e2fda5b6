"""Language identification: held-out accuracy, folds, awkward rows."""

import math
import random
import re
import zlib
from collections import Counter

from pyspark.sql import functions as F

from cases import EDGE, edge_docs, no_docs
from shiftline.llm import language, queries

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op10_language(spark, SF).collect()}
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert set(rows) == set(docs)
    for doc_id, r in rows.items():
        assert r.held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    held = [d for d, r in rows.items() if r.held_out and docs[d].lang]
    assert sum(rows[d].lang_pred == docs[d].lang for d in held) / len(held) >= 0.98


def test_held_out_languages_and_sources_do_not_matter(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4))
    turned = docs.withColumn("lang", F.when(fold == 2, F.lit("xx")).otherwise(F.col("lang"))).withColumns(
        {"source": F.lit("s"), "lang_pred": F.lit("q"), "gram": F.lit("g")})
    settings = language.Settings(docs=60)
    assert sorted(language.identify(docs, settings).collect()) == sorted(language.identify(turned, settings).collect())


def test_backoff_goes_to_shorter_grams(spark):
    docs = spark.createDataFrame([(k, f"{w} abc"[: 99], lang, None, 0) for k, (w, lang) in enumerate(
        [("wolken", "de"), ("clouds", "en")] * 20)], "doc_id long, text string, lang string, source string, n_chars long")
    scorer = language.Scorer(language.learn(docs))
    assert scorer.predict("wolken")[0] == "de" and scorer.predict("xwolke")[0] == "de" and scorer.predict("oudz")[0] == "en"
    assert scorer.predict("² ½ 12")[0] == "und" and scorer.predict("² é")[0] in ("de", "en")
    assert (scorer.back_off("ßß") == scorer.blank).all()
    known = {k for k, _ in scorer.grams}
    assert known == {1, 2, 3, 4}


def test_rare_words_and_grams_of_rich_vocabularies_are_learned(spark):
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(18_000)})[:15_000]
    docs = spark.createDataFrame([(k, " ".join(words), "en", None, 0) for k in (1, 4)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    logs = language.learn(docs)["logs"]
    assert set(words) == set(logs[0][0])
    assert {k: set(logs[k][0]) for k in (4, 3, 2, 1)} == {k: {g for w in words for g in language.grams_of(w, k)} for k in (4, 3, 2, 1)}


def _plain_model(rows):
    """Counts of words and n-grams by language, with nothing left out."""
    learned = [(lang, text) for doc_id, text, lang in rows if lang is not None and zlib.crc32(str(doc_id).encode()) % 4 != 2]
    counts, share = {k: {} for k in (0, 1, 2, 3, 4)}, Counter(lang for lang, _ in learned)
    for lang, text in learned:
        for word in re.findall(r"[^\W\d_]+", (text or "").lower()):
            counts[0].setdefault(lang, Counter())[word] += 1
            for k in (1, 2, 3, 4):
                padded = word if k == 1 else f" {word} "
                counts[k].setdefault(lang, Counter()).update(padded[i:i + k] for i in range(len(padded) - k + 1))
    return counts, share


def _plain_predict(text, counts, share):
    keys = {k: set().union(*by.values()) for k, by in counts.items()}
    log = lambda k, lang, key: math.log((counts[k][lang][key] or 0.5) / (
        counts[k][lang].total() + 0.5 * len(keys[k])))
    words = re.findall(r"[^\W\d_]+", (text or "").lower())
    if not any(c.isalpha() for w in words for c in w):
        return "und", 0.0
    total = {lang: math.log(n / share.total()) for lang, n in share.items()}
    for word in words:
        for k in (0, 4, 3, 2, 1):
            padded = word if k < 2 else f" {word} "
            parts = [word] if k == 0 else [padded[i:i + k] for i in range(len(padded) - k + 1)]
            if found := [p for p in parts if p in keys[k]]:
                for lang in total:
                    total[lang] += sum(log(k, lang, p) for p in found) / max(1, k)
                break
    best = max(sorted(total), key=total.get)
    return best, 1 / sum(math.exp(v - total[best]) for v in total.values())


def test_equals_a_plain_scorer(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    model = _plain_model(rows)
    for r in language.identify(docs).collect():
        text = next(t for d, t, _ in rows if d == r.doc_id)[:3000]
        if len(text) < 3000:
            lang, score = _plain_predict(text, *model)
            assert r.lang_pred == lang and abs(r.score - score) < 1e-3


def test_a_hot_language_learns_from_a_bounded_sample(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.translate(
        F.col("id").cast("string"), "0123456789", "abcdefghij")).alias("text"), F.lit("en").alias("lang"))
    learned = set(language.learn(docs, language.Settings(docs=30))["logs"][0][0])
    assert len(learned) == 30 and learned == set(language.learn(docs.repartition(3), language.Settings(docs=30))["logs"][0][0])
    held = {r.text for r in docs.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2).collect()}
    assert learned.isdisjoint(held)


def test_awkward_rows(spark):
    rows = language.identify(edge_docs(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(r[0]) for r in EDGE)
    by = {r.doc_id: r for r in rows}
    assert {by[k].lang_pred for k in (1, 2, 3, 10)} == {"und"} and by[1].score == 0.0
    assert by[7].lang_pred == by[8].lang_pred
    assert language.identify(no_docs(spark)).collect() == []
    unlabelled = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(unlabelled).collect()} == {"und"}
    kept = language.keep_known(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns and {r.doc_id for r in kept.collect()}.isdisjoint({1, 2, 3, 10})
