"""Awkward inputs shared by the operators' tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; an input may have them too.
CLASH = ["size", "text_hash", "copies", "copy", "place", "score", "label", "h", "w", "part", "node", "grp",
         "key", "row", "kept", "component", "digest", "n_words", "bands", "host", "target", "taken"]

LONG = " ".join(f"word{k % 977} of" for k in range(40_000))
EDGE = [
    (1, None, None, None, None), (2, "", "en", "a", 0), (3, "   \n\t ", "en", "a", 6), (4, "one", "en", None, 3),
    (5, LONG, "en", "b", len(LONG)), (6, "é 日本語 🎉 \x00 <|endoftext|> [INST]", "fr", "b", 30),
    (7, "same text here for all of us to read today", "en", "a", 42),
    (7, "same text here for all of us to read today", "en", "a", 42),
    (8, "same text here for all of us to read today", None, "a", 42),
    (None, "same text here for all of us to read today", "en", "a", 42),
    (9, "x" * 300_000, "de", "c", 300_000), (10, "1234 5678 !!!", "de", "c", 13),
]

_WORDS = [f"near{k}" for k in range(60)]
#: Ids with two texts (3, 21, 30), and near copies of a text with and without ids.
SHARED = [(i, text, "en", "a", len(text)) for i, text in (
    (2, "first text of five words"), (3, "first text of five words"), (3, "second text of six other words"),
    (9, "second text of six other words"), (21, ""), (20, "third text of five words"), (21, "third text of five words"),
    (30, "alone with this id here"), (30, "and another text for it"),
    (None, " ".join(_WORDS[1:])), (40, " ".join(_WORDS)), (None, " ".join([*_WORDS[2:], "end"])),
    (None, "no id and like no other"))]


def edge_docs(spark):
    """EDGE with columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    df = spark.createDataFrame(EDGE, DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASH})


def no_docs(spark):
    return spark.createDataFrame([], DOCS)


def texts():
    return [r[1] or "" for r in EDGE]
