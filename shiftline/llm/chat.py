r"""Chat formatting with Spark expressions only.

A conversation's turns are collected as structs, sorted, cut into runs of the
same role, and concatenated under a template:

    <s>[INST] user text [/INST]</s><s>[ANS] answer [SEP] more [/ANS]</s>

``[SYS]``, ``[INST]`` and ``[ANS]`` mark system, user and assistant runs, any
other role is ``[ROLE hex]`` with its UTF-8 name in hexadecimal, and ``[SEP]``
stands between the turns that one run merges. Inside a text every backslash
is doubled and a control string gets a backslash after its first character
(``</s>`` becomes ``<\/s>``), so an escaped text holds no control string and
unescaping gives the text back exactly.

Defined cases: a null text or role counts as the empty string; turns sort by
(turn, role, text) with a null turn first, so ties and repeated rows have one
order; rows with a null conv_id form one conversation; a conversation without
rows does not appear; other columns are ignored. A conversation is one output
value, so it must fit a row; all work on it is linear in its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks of the template.
MARKS = {"system": "SYS", "user": "INST", "assistant": "ANS"}
OTHER, SEPARATOR, LOSS_ROLE = "ROLE", " [SEP] ", "assistant"
RUN = r"(?s)^<s>\[([A-Z]+)(?: ([0-9A-F]*))?\] (.*) \[/\1\]$"
CONTROL_TAIL = r"(?=/?(?:s>|(?:SYS|INST|ANS|ROLE|SEP)\]|ROLE ))"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])" + CONTROL_TAIL, r"$1\\")


def unescape(text: Column) -> Column:
    opened = F.regexp_replace(text, r"([<\[])\\" + CONTROL_TAIL, "$1")
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def _by_role(role: Column, of, other: Column) -> Column:
    chosen = other
    for name, mark in MARKS.items():
        chosen = F.when(role == name, F.lit(of(mark))).otherwise(chosen)
    return chosen


def runs(conversations: DataFrame) -> DataFrame:
    """conv_id, runs array<struct<role, texts array<string>>>: sorted, same-role turns merged."""
    turn = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    collected = conversations.select("conv_id", turn.alias("t")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("t")).alias("turns"))
    starts = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]))
    cut = collected.withColumn("starts", starts)
    merged = F.transform("starts", lambda s, k: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s)["text"]
        .alias("texts")))
    return cut.select("conv_id", merged.alias("runs"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, formatted, segments array<struct<text, loss>>.

    The segments' texts concatenated are ``formatted``; ``loss`` marks the
    assistant texts, without marks and separators: the loss mask.
    """
    def segment(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    def of_run(run: Column) -> Column:
        role, no = run["role"], F.lit(False)
        name = F.hex(F.encode(role, "utf-8"))
        opened = _by_role(role, lambda m: f"<s>[{m}] ", F.concat(F.lit(f"<s>[{OTHER} "), name, F.lit("] ")))
        closed = _by_role(role, lambda m: f" [/{m}]</s>", F.lit(f" [/{OTHER}]</s>"))
        texts = F.transform(run["texts"], lambda t, j: F.array(
            segment(F.when(j > 0, F.lit(SEPARATOR)).otherwise(F.lit("")), no),
            segment(escape(t), role == LOSS_ROLE)))
        return F.concat(F.array(segment(opened, no)), F.flatten(texts), F.array(segment(closed, no)))

    marked = runs(conversations).select(
        "conv_id", F.flatten(F.transform("runs", of_run)).alias("segments"))
    return marked.select("conv_id", F.array_join(F.col("segments")["text"], "").alias("formatted"),
                         "segments")


def read_back(formatted: Column) -> Column:
    """The turns array<struct<role, text>> that a formatted conversation holds."""
    def of_run(run: Column) -> Column:
        mark = F.regexp_extract(run, RUN, 1)
        role = F.decode(F.unhex(F.regexp_extract(run, RUN, 2)), "utf-8")
        for name, m in MARKS.items():
            role = F.when(mark == m, F.lit(name)).otherwise(role)
        texts = F.split(F.regexp_extract(run, RUN, 3), r" \[SEP\] ", -1)
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    pieces = F.split(formatted, "</s>", -1)
    return F.flatten(F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), of_run))


def digests(conversations: DataFrame) -> DataFrame:
    """Per conversation what its output holds: turns read back, loss text, lengths."""
    line = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescape(s["text"]))
    back = format_conversations(conversations).select(
        "conv_id", "formatted", read_back(F.col("formatted")).alias("turns"),
        F.array_join(under, "").alias("loss_text"))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))
