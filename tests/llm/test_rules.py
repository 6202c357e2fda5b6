"""Quality rules: measurements, verdicts and ablations against plain Python."""

import random
import re
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cases import EDGE, edge_docs, no_docs
from conftest import SF_SMALL
from shiftline.llm import queries, rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _measure(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    every = text.split("\n")
    lines = [x for x in every if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)),
            len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}), len(lines),
            sum(any(c.isalpha() for c in w) for w in words), sum(bool(re.match(r"[ \t]*[-*•]", x)) for x in every),
            sum(bool(re.search(r"(\.\.\.|…)[ \t\x0b-\x0d]*\Z", x)) for x in every))


def _fails(m):
    n, chars, symbols, dup, repeat, lines, lettered, bullets, ellipses = m
    bits = [n < 50, 100 * repeat > 50 * n, n > 1_000_000, chars < 2 * n, chars > 15 * n, 100 * symbols > 10 * n,
            100 * dup > 30 * lines, 100 * lettered < 80 * n, 100 * bullets > 90 * lines, 100 * ellipses > 30 * lines]
    return sum(b << k for k, b in enumerate(bits))


def _rejects(policy, fails, without=0):
    fatal, soft = rules.mask_of(*policy.fatal) & ~without, rules.mask_of(*policy.soft) & ~without
    return bool(fails & fatal) or (fails & soft).bit_count() > policy.allowed


def _made():
    rnd = random.Random(13)
    long = " ".join(rnd.choice("abcdefgh") * rnd.randrange(1, 9) for _ in range(300))
    return [(k, t) for k, t in enumerate([
        "a b c a b c", "a b", "a b c d\na b c d\n\n \t\na b c d", "- one\n* two\n • three\n-", "wait...\nso… \nthen ... no",
        "#a *b %c " * 30, "1 2 3 " * 40, long, long + "\n" + long, "x" * 2000, "a\rb\x0bc d　e", "...\n", "é ü ñ " * 60,
        " ".join(str(k) for k in range(80)), *["".join(rnd.choice("ab#. \n-•…") for _ in range(rnd.randrange(300)))
                                             for _ in range(60)]])]


def _check(rows, docs):
    got = sorted(((r.doc_id, *[r[m] for m in rules.MEASURES], r.fails, r.base_failed, r.kept) for r in rows), key=repr)
    want = []
    for doc_id, text in docs:
        m = _measure(text)
        fails = _fails(m)
        want.append((doc_id, *m, fails, bool(fails & 3), not _rejects(rules.POLICIES[rules.CURRENT], fails)))
    assert got == sorted(want, key=repr)


def test_ledger(spark):
    docs = _made()
    _check(rules.judge(rules.ledger(spark.createDataFrame(docs, "doc_id long, text string"))).collect(), docs)
    edge = [d for d in EDGE if len(d[1] or "") < 10**6]
    _check(rules.judge(rules.ledger(edge_docs(spark))).collect(), [(r[0], r[1]) for r in edge])
    assert rules.judge(rules.ledger(no_docs(spark))).collect() == []


def test_query_and_plan(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    df = queries.op13_quality_rules(spark, SF_SMALL)
    _check(df.collect(), docs)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
    # the words are cut once, however many rules read them
    assert plan.count(f"{rules.WORD}, 0)") == 1 and plan.count("sort_array") == 1


def test_keep_leaves_columns_alone(spark):
    docs = edge_docs(spark)
    kept = rules.keep(docs)
    assert kept.columns == docs.columns
    policy = rules.POLICIES[rules.CURRENT]
    want = sorted((r[0], r[1]) for r in EDGE if not _rejects(policy, _fails(_measure(r[1]))))
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == want
    assert rules.keep(no_docs(spark)).collect() == []


@pytest.mark.parametrize("version", sorted(rules.POLICIES))
def test_ablation(spark, version):
    policy = rules.POLICIES[version]
    docs = _made() + [(r[0], r[1]) for r in EDGE]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    held = [(_measure(t)[0], _fails(_measure(t))) for _, t in docs]
    active = rules.mask_of(*policy.fatal, *policy.soft)
    got = {r.rule: r for r in rules.ablate(rules.ledger(df), policy).collect()}
    assert list(got) == [r.name for r in rules.RULES if r.name in policy.fatal + policy.soft]
    for name, row in got.items():
        bit = rules.BIT[name]
        failed = [(n, f & active & ~bit) for n, f in held if f & bit]
        only = [n for n, f in held if _rejects(policy, f) and not _rejects(policy, f, bit)]
        every, some = (active & ~bit if failed else 0), 0
        for _, f in failed:
            every, some = every & f, some | f
        assert (row.n_failed, row.words_failed, row.n_only, row.words_only, row.always_with, row.ever_with) == (
            len(failed), sum(n for n, _ in failed), len(only), sum(only), every, some)


def test_a_stored_ledger_serves_policies_of_its_rule_set_only(spark, tmp_dir):
    docs = spark.createDataFrame(_made(), "doc_id long, text string")
    rules.ledger(docs).write.parquet(f"{tmp_dir}/ledger")
    book = spark.read.parquet(f"{tmp_dir}/ledger")
    kept = {v: book.transform(rules.judge, p).where("kept").count() for v, p in rules.POLICIES.items()}
    assert kept[1] >= kept[2] >= kept[3] > 0
    with pytest.raises(PySparkException, match="rule set"):
        rules.judge(book.withColumn("rule_set", F.lit(0))).collect()
    with pytest.raises(ValueError, match="ledger"):
        rules.measured(docs.withColumn("n_words", F.lit(1)), ["n_words"])
