"""Rules that reject low-quality texts, run as a short-circuit cascade.

Every rule is a column expression over a text's measures. Cost and selectivity of each rule are
estimated on a bounded sample, the rules are ordered by rejections per unit of cost, and one
``CASE`` expression applies them: a row that one rule rejects is not put to the rules behind it.
The order decides the time taken, never which texts are kept.

Defined results: a missing text counts as empty, and an empty text has no words and fails the base
rule; repeated rows are judged each for itself; an empty table gives an empty result; columns of
the input are kept as they are (``quality_measures`` puts its own into one struct, so names can't
clash). Everything is built-in expressions within one row: no shuffle, no Python.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.text import NOT_SPACE, unused, whole, words

WINDOW = 5
#: Bounds of the sample on which rules are timed: rows, characters of a row, times it is repeated.
SAMPLE_ROWS, SAMPLE_CHARS, SAMPLE_REPEATS = 200, 20_000, 10


@dataclass(frozen=True)
class Rule:
    """``rejects`` gets the text and the struct of measures and gives true for bad texts."""

    name: str
    rejects: Callable[[Column, Column], Column]


#: The verdict beside the base rule. A share is compared as a product, so nothing is divided.
RULES: tuple[Rule, ...] = (
    Rule("symbols", lambda t, m: m.n_symbols * 10 > m.n_words * 2),
    Rule("duplicate_lines",
         lambda t, m: (m.n_dup_lines >= 3) & (m.n_dup_lines * 10 > F.size(F.split(t, "\n")) * 3)),
    Rule("capitals",
         lambda t, m: F.length(F.regexp_replace(t, r"\P{Lu}+", "")) * 2
         > F.length(F.regexp_replace(t, r"\P{L}+", ""))),
    Rule("exclamations", lambda t, m: F.regexp_count(t, F.lit("!!")) * 5 > m.n_words),
    Rule("word_length", lambda t, m: (m.word_chars < m.n_words * 2)
         | (m.word_chars > m.n_words * 25)),
    Rule("letters", lambda t, m: F.length(F.regexp_replace(t, r"\P{L}+", "")) * 2 < m.word_chars),
)


def base_failed(m: Column) -> Column:
    return (m.n_words < 10) | (m.n_repeat_words * 100 > m.n_words * 20)


def quality_measures(df: DataFrame, text: str = "text", into: str = "measures") -> DataFrame:
    """Add a struct of n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words.

    Each step is a column of its own that the next one uses more than once; the optimizer then
    keeps it and does not evaluate it again for every element.
    """
    own = unused(df, f"__{into}_")
    name = {c: own + c for c in ("text", "words", "hashes", "sorted", "places", "lines")}
    col = {k: F.col(v) for k, v in name.items()}
    out = df.withColumn(name["text"], whole(text)).withColumn(name["words"], words(name["text"]))

    w = col["words"]
    starts = F.slice(w, F.lit(1), F.greatest(F.size(w) - (WINDOW - 1), F.lit(0)))
    out = out.withColumn(name["hashes"], F.transform(starts, lambda x, i: F.xxhash64(
        x, *[F.get(w, i + k) for k in range(1, WINDOW)])))
    h = col["hashes"]
    repeated = F.size(F.array_distinct(h)) < F.size(h)
    pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn(name["sorted"], F.when(repeated, pairs))
    s = col["sorted"]
    again = F.filter(s, lambda x, i: F.coalesce(x.h == F.get(s, i - 1).h, F.lit(False))
                     | F.coalesce(x.h == F.get(s, i + 1).h, F.lit(False)))
    out = out.withColumn(name["places"], F.when(s.isNotNull(), F.sort_array(
        F.transform(again, lambda x: x.i))))
    p = col["places"]
    covered = F.aggregate(
        F.transform(p, lambda x, i: F.least(F.lit(WINDOW),
                                            F.coalesce(F.get(p, i + 1) - x, F.lit(WINDOW)))),
        F.lit(0).cast("long"), lambda a, x: a + x)
    lines = F.filter(F.split(col["text"], "\n"), lambda x: x.rlike(NOT_SPACE))
    out = out.withColumn(name["lines"], lines)
    n_lines = col["lines"]
    measures = F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(col["text"], F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size(n_lines) - F.size(F.array_distinct(n_lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    )
    return out.withColumn(into, measures).drop(*name.values())


@dataclass(frozen=True)
class RuleEstimate:
    rule: Rule
    seconds: float
    rejected: int


def estimate(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text",
             rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
             repeats: int = SAMPLE_REPEATS) -> list[RuleEstimate]:
    """Time each rule, and count what it rejects, on at most ``rows`` texts of ``chars`` each."""
    measured = quality_measures(
        df.where(F.length(text) <= chars).select(F.col(text).alias("text")), "text", "m")
    sample = measured.take(rows)
    if not sample:
        return [RuleEstimate(r, 1.0, 0) for r in rules]
    probe = df.sparkSession.createDataFrame(sample, measured.schema).repartition(1)
    probe = probe.withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(repeats))))

    def seconds(rejects: Column) -> tuple[float, int]:
        began = time.perf_counter()
        n = probe.agg(F.sum(rejects.cast("long"))).first()[0]
        return time.perf_counter() - began, (n or 0) // repeats

    text_col, m = F.col("text"), F.col("m")
    idle = min(seconds(m.n_words < 0)[0] for _ in range(2))
    found = []
    for rule in rules:
        took, rejected = seconds(rule.rejects(text_col, m))
        found.append(RuleEstimate(rule, max(took - idle, 1e-3), rejected))
    return found


def by_worth(estimates: Sequence[RuleEstimate]) -> list[Rule]:
    """Most rejections per second first; ties keep the given order."""
    return [e.rule for e in sorted(estimates, key=lambda e: -e.rejected / e.seconds)]


def first_rejection(rules: Sequence[Rule], text: Column, measures: Column) -> Column:
    """Name of the first rule that rejects a text; null if none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(text, measures), F.lit(rule.name)).otherwise(verdict)
    return verdict


def apply_quality_rules(df: DataFrame, rules: Sequence[Rule] = RULES,
                        text: str = "text", into: str = "measures") -> DataFrame:
    """Add ``measures``, ``base_failed`` and ``rejected_by`` ('base', a rule's name, or null)."""
    ordered = by_worth(estimate(df, rules, text))
    judged = quality_measures(df, text, into)
    m = F.col(into)
    return (judged.withColumn("base_failed", base_failed(m))
            .withColumn("rejected_by", F.when(F.col("base_failed"), F.lit("base"))
                        .otherwise(first_rejection(ordered, whole(text), m))))


def keep_good(df: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The rows of ``df`` that neither the base rule nor any other rejects, columns unchanged."""
    ordered = by_worth(estimate(df, rules, text))
    # the row number keeps the optimizer from pushing the filter below the measures, which would
    # spell them out, and evaluate them, once for every use
    own = unused(df, "__judged")
    measures, row = f"{own}_measures", f"{own}_row"
    judged = quality_measures(df, text, measures).withColumn(
        row, F.monotonically_increasing_id())
    m = F.col(measures)
    rejected = base_failed(m) | first_rejection(ordered, whole(text), m).isNotNull()
    return judged.where((F.col(row) >= 0) & ~rejected).drop(measures, row)
