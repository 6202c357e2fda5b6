"""Chat formatting: what is read back equals the rows."""

import hashlib
import itertools
import random

from pyspark.sql import functions as F

from conftest import SF_SMALL
from shiftline.llm import chat, queries

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["<s>", "</s>", "[INST]", "[/INST]", "[SYS]", "[/ANS]", "[ROLE 41] ", "[SEP]", " [SEP] ", "\\", "\\\\", "[", "<",
          "/s>", "INST]", " ", "\n", "$1", "ok", "é🎉"]


def _rows():
    rnd = random.Random(8)
    rows = [(1, None, "user", "first"), (1, 0, None, None), (1, 0, "user", ""), (2, 5, "tool [x] </s>", "t"),
            (2, 5, "tool [x] </s>", "t"), (None, 0, "assistant", "lost"), (3, 0, "assistant", "\\[INST] <\\/s> \\")]
    for conv in range(10, 60):
        for turn in range(rnd.randrange(1, 12)):
            role = rnd.choice(["user", "assistant", "assistant", "system", "tool", ""])
            rows.append((conv, turn, role, "".join(rnd.choice(PIECES) for _ in range(rnd.randrange(8)))))
    return rows


def _expected(rows):
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, own in itertools.groupby(sorted(rows, key=lambda r: (r[0] or -1, order(r))), key=lambda r: r[0]):
        yield conv, [(r[2] or "", r[3] or "") for r in own]


def test_read_back_equals_the_rows(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("turns", F.lit("clash")).withColumn("runs", F.lit(1))
    got = {r.conv_id: r for r in chat.digests(df).collect()}
    want = dict(_expected(rows))
    assert set(got) == set(want)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in want.items():
        r, loss = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == sha("".join(f"{a}\n{b}\n" for a, b in turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), sha(loss))


def test_texts_hold_no_control_string_and_runs_are_merged(spark):
    df = chat.format_conversations(spark.createDataFrame(_rows(), SCHEMA))
    for r in df.collect():
        assert "".join(s.text for s in r.segments) == r.formatted
        for s in r.segments:
            assert not s.loss or not any(c in s.text for c in PIECES[:9])
    runs = chat.runs(spark.createDataFrame([(1, k, r, str(k)) for k, r in enumerate(["user"] * 3 + ["assistant"] * 2)], SCHEMA))
    assert [(x.role, x.texts) for x in runs.first().runs] == [("user", ["0", "1", "2"]), ("assistant", ["3", "4"])]


def test_query_and_empty_table(spark):
    rows = {r.conv_id: r for r in queries.op2_chat(spark, SF_SMALL).collect()}
    assert rows[-7].n_turns == 2 and rows[-7].loss_chars == 21
    assert chat.digests(spark.createDataFrame([], SCHEMA)).collect() == []


def test_plan_is_native(spark):
    plan = queries.op2_chat(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1
