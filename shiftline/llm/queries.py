"""One query per operator: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftline.llm import (bpe, chat, collocations, hamming, language, licenses, mixing, near, pages, quality,
                           resample, rules, winnow)
from shiftline.llm.common import constant, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    marks = "</s>[INST] ok [/INST]"
    probe = constant(spark, " ".join(columns), [(-7, 0, "user", marks), (-7, 1, "assistant", marks)])
    return chat.digests(table(spark, sf_dir, "conversations").select(*columns).unionByName(probe))


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hamming.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.with_next(table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.link(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.main_texts(table(spark, sf_dir, "pages"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(rules.ledger(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_bpe": op1_bpe,
    "op2_chat": op2_chat,
    "op3_topk": op3_topk,
    "op4_licenses": op4_licenses,
    "op5_winnowing": op5_winnowing,
    "op6_quality": op6_quality,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_mixing": op8_mixing,
    "op9_html": op9_html,
    "op10_language": op10_language,
    "op11_importance": op11_importance,
    "op12_collocations": op12_collocations,
    "op13_quality_rules": op13_quality_rules,
}

ORACLE_SQL: dict[str, str] = {
    "op2_chat": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
placed AS (
  SELECT *, row_number() OVER w AS k, lag(role) OVER w AS before
  FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, 2 * length(text) - length(replace(text, '\', ''))
           + len(regexp_extract_all(text, '[<\[]/?(?:s>|(?:SYS|INST|ANS|ROLE|SEP)\]|ROLE )'))
           + CASE WHEN before = role THEN 7
                  WHEN role IN ('system', 'assistant') THEN 20 WHEN role = 'user' THEN 22
                  ELSE 23 + 2 * strlen(role) END AS chars
  FROM placed)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id""",
    "op3_topk": """
WITH coded AS (
  SELECT vec_id, list_transform(embedding, lambda x: coalesce(x > 0 AND NOT isnan(x), false)) AS bits
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL),
pairs AS (
  SELECT q.vec_id AS query_id, e.vec_id AS neighbour_id,
         len(list_filter(range(1, greatest(len(q.bits), len(e.bits)) + 1),
             lambda i: coalesce(q.bits[i], false) <> coalesce(e.bits[i], false))) AS distance
  FROM coded q JOIN coded e ON q.vec_id <> e.vec_id WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM pairs)
SELECT query_id, rank::INT AS rank, neighbour_id, distance::INT AS distance FROM ranked WHERE rank <= 10""",
    "op11_importance": r"""
WITH crc AS (
  SELECT list(list_reduce([b::UBIGINT] || range(8)::UBIGINT[],
           lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END) ORDER BY b) AS byte
  FROM range(256) t(b)),
cut AS (
  SELECT row_number() OVER () AS r, doc_id, unnest([regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')]) AS w
  FROM documents),
target AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
  FROM benchmark),
corpus AS (SELECT r, unnest(w) AS word FROM cut),
buckets AS (
  SELECT word, (xor(list_reduce([4294967295::UBIGINT] || list_transform(range(strlen(word)),
           lambda i: ('0x' || substr(hex(word), (2 * i + 1)::BIGINT, 2))::UBIGINT),
           lambda c, x: xor(c >> 8, byte[(xor(c & 255, x) + 1)::BIGINT])), 4294967295::UBIGINT) % 10000)::BIGINT AS bucket
  FROM (SELECT word FROM corpus UNION SELECT word FROM target), crc),
s AS (SELECT bucket, count(*)::DOUBLE AS s FROM corpus JOIN buckets USING (word) GROUP BY bucket),
t AS (SELECT bucket, count(*)::DOUBLE AS t FROM target JOIN buckets USING (word) GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM corpus)::DOUBLE + 10000)
           / ((s + 1) * ((SELECT count(*) FROM target)::DOUBLE + 10000))))::BIGINT AS gain
  FROM s LEFT JOIN t USING (bucket)),
weights AS (
  SELECT r, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM corpus JOIN buckets USING (word) JOIN gains USING (bucket) GROUP BY r),
scored AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
           (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT::DOUBLE + 0.5)
           / 4294967296::DOUBLE)))::BIGINT AS score
  FROM cut LEFT JOIN weights USING (r)),
ranked AS (
  SELECT *, n_features >= 20 AS able, row_number() OVER (PARTITION BY n_features >= 20
           ORDER BY score DESC, doc_id NULLS LAST, n_features) AS place,
         count(*) FILTER (n_features >= 20) OVER () AS all_able
  FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= all_able * 10 // 100 THEN place END AS rank
FROM ranked""",
    "op12_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
sizes AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces),
counted AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
  FROM places, range(1, 6) t(m) WHERE i + m - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 100),
candidates AS (SELECT * FROM counted WHERE m > 1),
free AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates o WHERE o.lang = c.lang AND o.m > c.m AND 100 * o.f >= 100 * c.f
      AND contains(' ' || o.phrase || ' ', ' ' || c.phrase || ' '))),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS first,
         array_to_string(string_split(phrase, ' ')[k + 1:], ' ') AS rest
  FROM free, range(1, 5) t(k) WHERE k < m),
scored AS (
  SELECT c.*, x.f AS l, y.f AS r, n, (1000::HUGEINT * a * n // (x.f::HUGEINT * y.f))::BIGINT AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.first
  JOIN counted y ON y.lang = c.lang AND y.phrase = c.rest JOIN sizes z ON z.lang = c.lang),
best AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS pick FROM scored),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best WHERE pick = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000""",
    "op13_quality_rules": r"""
WITH cut AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         string_split(coalesce(text, ''), chr(10)) AS all_lines,
         list_filter(all_lines, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
placed AS (SELECT r, unnest(range(len(w) - 2)) AS i, w FROM cut WHERE len(w) > 2),
windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, w[i + 1], w[i + 2], w[i + 3]) AS k FROM placed),
covered AS (SELECT r, count(DISTINCT i + j) AS n FROM windows, range(3) t(j) WHERE k > 1 GROUP BY r),
measured AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines)::BIGINT AS n_lines, len(regexp_extract_all(t, '\p{L}[^\x20\x09-\x0D]*'))::BIGINT AS n_lettered,
         len(list_filter(all_lines, lambda x: regexp_matches(x, '^[\x20\x09]*[-*\x{2022}]')))::BIGINT AS n_bullets,
         len(list_filter(all_lines, lambda x: regexp_matches(x, '(\.\.\.|\x{2026})[\x20\x09\x0B-\x0D]*$')))::BIGINT
           AS n_ellipses
  FROM cut LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, ((n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT
             + 4 * (n_words > 1000000)::BIGINT + 8 * (word_chars < 2 * n_words)::BIGINT
             + 16 * (word_chars > 15 * n_words)::BIGINT + 32 * (100 * n_symbols > 10 * n_words)::BIGINT
             + 64 * (100 * n_dup_lines > 30 * n_lines)::BIGINT + 128 * (100 * n_lettered < 80 * n_words)::BIGINT
             + 256 * (100 * n_bullets > 90 * n_lines)::BIGINT + 512 * (100 * n_ellipses > 30 * n_lines)::BIGINT) AS fails
  FROM measured)
SELECT *, 1 AS rule_set, 3 AS policy, fails & 3 <> 0 AS base_failed, fails = 0 AS kept FROM judged""",
}
