"""Quality rules as a ledger of failure bits, with Spark expressions only.

1. ``ledger`` reads every text once, takes the measurements and evaluates every
   rule of ``RULES`` once: rule k sets bit k of ``fails``. Neither depends on a
   policy, so a stored ledger serves all policies of its rule set.
2. ``judge`` applies one of the versioned ``POLICIES``: a document goes if it
   fails a fatal rule, or more than ``allowed`` of the soft ones.
3. ``ablate`` tells for every rule of a policy what it rejects, what it alone
   rejects, and which other rules fail with it. Rows are first counted by mask,
   at most one row for each set of bits, and only those few rows are combined.

Repeated windows are found inside the row: the windows of three words, with
their places, are sorted, so equal ones are neighbours; the places they cover
are counted once. Nothing is shuffled but the counts of ``ablate``.

Defined cases: a null or empty text has no words and fails ``few_words``; rows
that repeat are judged alike, one row each; a null doc_id is an id like any
other; an empty table gives an empty ledger; other columns are ignored by
``ledger`` and kept by ``keep``, whatever their names. Shares are compared as
integers, so nothing is rounded. A text is one row: its words and windows must
fit a task, about 200 bytes a word.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftline.llm.common import fresh

WORD = r"[^\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"
#: A word's part from its first letter on: one match for each word with a letter.
LETTERED = r"\p{L}[^\x20\x09-\x0D]*"
BULLET = r"(?:^|\n)[\x20\x09]*[-*\x{2022}]"
ELLIPSIS = r"(?:\.\.\.|\x{2026})[\x20\x09\x0B-\x0D]*(?:\n|\z)"
WINDOW = 3

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_lettered",
            "n_bullets", "n_ellipses"]


@dataclass(frozen=True)
class Rule:
    """A name and when a document fails, from its measurements."""
    name: str
    fails: Callable[[], Column]


def _more(part: str, percent: int, whole: str) -> Callable[[], Column]:
    return lambda: 100 * F.col(part) > percent * F.col(whole)


#: Bit k of a ledger is rule k. A changed list is a new rule set: raise RULE_SET.
RULE_SET = 1
RULES = [
    Rule("few_words", lambda: F.col("n_words") < 50),
    Rule("repeated_words", _more("n_repeat_words", 50, "n_words")),
    Rule("many_words", lambda: F.col("n_words") > 1_000_000),
    Rule("short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule("long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
    Rule("symbols", _more("n_symbols", 10, "n_words")),
    Rule("repeated_lines", _more("n_dup_lines", 30, "n_lines")),
    Rule("few_lettered", lambda: 100 * F.col("n_lettered") < 80 * F.col("n_words")),
    Rule("bullets", _more("n_bullets", 90, "n_lines")),
    Rule("ellipses", _more("n_ellipses", 30, "n_lines")),
]
BIT = {rule.name: 1 << k for k, rule in enumerate(RULES)}


def mask_of(*names: str) -> int:
    return reduce(int.__or__, (BIT[n] for n in names), 0)


BASE = mask_of("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """Rules by name that reject alone, and rules of which ``allowed`` may fail."""
    version: int
    fatal: tuple[str, ...]
    soft: tuple[str, ...] = ()
    allowed: int = 0
    rule_set: int = RULE_SET

    def rejects(self, fails: Column, without: int = 0) -> Column:
        """Whether a document of these failure bits goes, with the bits ``without`` left out."""
        fatal, soft = mask_of(*self.fatal) & ~without, mask_of(*self.soft) & ~without
        return (fails.bitwiseAND(F.lit(fatal)) != 0) | (
            F.bit_count(fails.bitwiseAND(F.lit(soft))) > self.allowed)


POLICIES = {p.version: p for p in (
    Policy(1, ("few_words", "repeated_words")),
    Policy(2, ("few_words", "repeated_words", "many_words", "symbols", "few_lettered"),
           ("short_words", "long_words", "repeated_lines", "bullets", "ellipses"), 1),
    Policy(3, ("few_words", "repeated_words", "many_words", "symbols", "few_lettered", "short_words", "long_words",
               "repeated_lines", "bullets", "ellipses")),
)}
CURRENT = 3


def _windows(words: Column) -> Column:
    """(a, b, c, at) of every three neighbouring words, sorted."""
    n = F.size(words) - (WINDOW - 1)
    part = lambda k: F.slice(words, k, F.greatest(n, F.lit(0)))
    at = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.sort_array(F.arrays_zip(part(1).alias("a"), part(2).alias("b"), part(3).alias("c"), at.alias("at")))


def _equal_neighbours(windows: Column) -> Column:
    """Pairs (x, y) of sorted windows that stand side by side and hold the same words."""
    n = F.greatest(F.size(windows) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(windows, 1, n).alias("x"), F.slice(windows, 2, n).alias("y"))
    return F.filter(pairs, lambda p: (p.x.a == p.y.a) & (p.x.b == p.y.b) & (p.x.c == p.y.c))


def _covered(pairs: Column) -> Column:
    """Number of word places that the windows of the pairs cover."""
    places = F.transform(pairs, lambda p: F.array(*[p[w].at + k for w in "xy" for k in range(WINDOW)]))
    return F.size(F.array_distinct(F.flatten(places)))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The ``keep`` columns and MEASURES (long) of every row of ``docs``.

    Every step is a projection over columns of the one before; the optimizer
    does not merge steps whose results are used more than once.
    """
    t, words, lines, windows, pairs = "_t", "_words", "_lines", "_windows", "_pairs"
    if taken := {t, words, lines, windows, pairs, *MEASURES} & {c.lower() for c in keep}:
        raise ValueError(f"columns {sorted(taken)} carry names of the ledger")
    cut = docs.select(*keep, F.coalesce(F.col("text"), F.lit("")).alias(t)).withColumns({
        words: F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        lines: F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))})
    # Only columns that later steps read are carried on.
    sizes = {
        "n_words": F.size(words), "word_chars": F.char_length(F.array_join(words, "")),
        "n_symbols": F.regexp_count(t, F.lit(SYMBOL)), "n_lines": F.size(lines),
        "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
        "n_lettered": F.regexp_count(t, F.lit(LETTERED)), "n_bullets": F.regexp_count(t, F.lit(BULLET)),
        "n_ellipses": F.regexp_count(t, F.lit(ELLIPSIS)), windows: _windows(F.col(words))}
    own = [m for m in MEASURES if m != "n_repeat_words"]
    sized = cut.select(*keep, *[c.alias(n) for n, c in sizes.items()])
    paired = sized.select(*keep, *own, _equal_neighbours(F.col(windows)).alias(pairs))
    counted = paired.select(*keep, *own, _covered(F.col(pairs)).alias("n_repeat_words"))
    return counted.select(*keep, *[F.col(m).cast("long").alias(m) for m in MEASURES])


def failure_bits() -> Column:
    """The failure bits of the measurements."""
    bits = [F.when(rule.fails(), F.lit(BIT[rule.name])).otherwise(F.lit(0)) for rule in RULES]
    return reduce(Column.bitwiseOR, bits).cast("long")


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, MEASURES, rule_set and fails of every row of ``docs``."""
    return measured(docs, ["doc_id"]).select(
        "*", F.lit(RULE_SET).alias("rule_set"), failure_bits().alias("fails"))


def judge(book: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The ledger with policy, base_failed and kept; a ledger of another rule set fails."""
    same = F.coalesce(F.col("rule_set") == policy.rule_set, F.lit(False))
    fails = F.when(same, F.col("fails")).otherwise(F.raise_error(F.lit(
        f"policy {policy.version} needs a ledger of rule set {policy.rule_set}")).cast("long"))
    return book.withColumn("fails", fails).withColumns({
        "policy": F.lit(policy.version), "base_failed": F.col("fails").bitwiseAND(F.lit(BASE)) != 0,
        "kept": ~policy.rejects(F.col("fails"))})


def keep(docs: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, all columns unchanged."""
    own = docs.columns
    at = fresh(docs, "row_of_ledger")
    held = docs.select(F.col("text"), F.struct(*[F.col(f"`{c}`") for c in own]).alias(at))
    judged = measured(held, [at]).withColumn("fails", failure_bits())
    return judged.where(~policy.rejects(F.col("fails"))).select(f"{at}.*")


def ablate(book: DataFrame, policy: Policy = POLICIES[CURRENT]) -> DataFrame:
    """A row for each rule of the policy, in bit order.

    policy, bit, rule; n_failed and words_failed: documents that fail it, and
    their words; n_only, words_only: what the policy would keep without the
    rule; always_with, ever_with: bits of the policy's other rules that fail
    in all, or any, of the documents that fail it.
    """
    names = [rule.name for rule in RULES if rule.name in policy.fatal + policy.soft]
    active = mask_of(*names)
    by_mask = judge(book, policy).groupBy(F.col("fails").bitwiseAND(F.lit(active)).alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("w"))
    rules = F.array(*[F.struct(F.lit(BIT[n]).cast("long").alias("bit"), F.lit(n).alias("rule"),
                               (policy.rejects(F.col("m")) & ~policy.rejects(F.col("m"), BIT[n])).alias("only"))
                      for n in names])
    each = by_mask.select("m", "n", "w", F.inline(rules))
    failed = F.col("m").bitwiseAND(F.col("bit")) != 0
    others = F.when(failed, F.col("m").bitwiseAND(F.bitwise_not("bit")))
    total = lambda c, when: F.coalesce(F.sum(F.when(when, F.col(c))), F.lit(0)).cast("long")
    return each.groupBy("bit", "rule").agg(
        total("n", failed).alias("n_failed"), total("w", failed).alias("words_failed"),
        total("n", F.col("only")).alias("n_only"), total("w", F.col("only")).alias("words_only"),
        F.coalesce(F.bit_and(others), F.lit(0).cast("long")).alias("always_with"),
        F.coalesce(F.bit_or(others), F.lit(0).cast("long")).alias("ever_with")).select(
        F.lit(policy.version).alias("policy"), "*").orderBy("bit")
