"""Quality rules as a short-circuit cascade.

Each rule is a condition under which a document is rejected. Rules have no order of their own: a
sample tells what share of documents each one rejects and what its evaluation costs, and the
cascade asks them by falling rejection per cost. A document that one rule rejects is not put to the
later ones. The order changes the work, and which of several failing rules is named; it never
changes which documents are kept. Cost is measured, so the named rule can differ between runs.

All measures are expressions of built-in functions over one row. Words are runs of characters
other than the six ASCII blanks. A null text has no words, lines or symbols, so it is rejected for
having few words, as an empty one is. Rows are never joined: repeated rows, ids and other columns
stay as they are. An empty sample leaves the rules in the order given.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpipe.llm.shared import checkpointed

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
#: Words of the windows in which repetition is looked for.
WINDOW = 8
#: Documents that cost and selectivity are estimated on; bounds nothing but that estimate.
SAMPLE_ROWS = 1000

MIN_WORDS = 20
REPEAT_PERCENT = 30


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def word_chars(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), SYMBOLS, "")).cast("long")


def n_capitals(text: Column) -> Column:
    return F.length(F.regexp_replace(F.coalesce(text, F.lit("")), r"\P{Lu}+", "")).cast("long")


def worded_lines(text: Column) -> Column:
    return F.filter(
        F.split(F.coalesce(text, F.lit("")), "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]")
    )


def n_dup_lines(text: Column) -> Column:
    return let(
        worded_lines(text), lambda lines: F.size(lines) - F.size(F.array_distinct(lines))
    ).cast("long")


def n_repeat_words(text: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that stand in the text more than once.

    Windows are compared by 64-bit hashes of their words' hashes. Most texts repeat none, which a
    count of distinct hashes settles; only the others sort their windows.
    """
    hashes = F.transform(words(text), lambda w: F.xxhash64(w))
    return F.when(
        F.size(words(text)) >= width,
        let(hashes, lambda h: let(_windows(h, width), lambda w: _covered(w, width))),
    ).otherwise(0).cast("long")


def _windows(hashes: Column, width: int) -> Column:
    starts = F.sequence(F.lit(0), F.size(hashes) - width)
    return F.transform(starts, lambda i: F.xxhash64(*(hashes[i + k] for k in range(width))))


def _covered(windows: Column, width: int) -> Column:
    def twice(ordered: Column) -> Column:
        last = F.size(ordered) - 1

        def same(i: Column, j: Column) -> Column:
            return ordered[i]["w"] == ordered[j]["w"]

        again = F.filter(
            F.sequence(F.lit(0), last),
            lambda i: F.when(i > 0, same(i, F.greatest(i - 1, F.lit(0)))).otherwise(False)
            | F.when(i < last, same(i, F.least(i + 1, last))).otherwise(False),
        )
        return F.array_sort(F.transform(again, lambda i: ordered[i]["at"]))

    def length(starts: Column) -> Column:
        last = F.size(starts) - 1
        return F.aggregate(
            F.sequence(F.lit(0), last),
            F.lit(0),
            lambda total, i: total
            + F.when(i == last, width).otherwise(
                F.least(F.lit(width), starts[F.least(i + 1, last)] - starts[i])
            ),
        )

    places = F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("at")))
    return F.when(
        F.size(F.array_distinct(windows)) < F.size(windows),
        let(F.sort_array(places), lambda ordered: let(twice(ordered), length)),
    ).otherwise(0)


@dataclass(frozen=True)
class Rule:
    """A name and, for a text column, the condition that rejects."""

    name: str
    rejects: Callable[[Column], Column]


BASE_RULES = (
    Rule("few_words", lambda t: n_words(t) < MIN_WORDS),
    Rule("repeated_words", lambda t: 100 * n_repeat_words(t) > REPEAT_PERCENT * n_words(t)),
)
MORE_RULES = (
    Rule("symbols", lambda t: 10 * n_symbols(t) > n_words(t)),
    Rule("duplicate_lines", lambda t: 2 * n_dup_lines(t) > F.size(worded_lines(t))),
    Rule("capitals", lambda t: 10 * n_capitals(t) > 4 * word_chars(t)),
    Rule(
        "word_length",
        lambda t: (word_chars(t) < 2 * n_words(t)) | (word_chars(t) > 20 * n_words(t)),
    ),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.seconds


def estimate(df: DataFrame, rules: Sequence[Rule]) -> list[Estimate]:
    """Cost and selectivity of each rule on a sample, best first; ties in the order given."""
    share = min(1.0, SAMPLE_ROWS / max(1, df.count()))
    sample = checkpointed(df.select("text").sample(share, 0).repartition(1))

    def run(condition: Column) -> tuple[int, int]:
        return tuple(sample.agg(F.count_if(condition), F.count("*")).first())

    def seconds(condition: Column) -> float:
        start = time.perf_counter()
        run(condition)
        return time.perf_counter() - start

    run(F.length("text") < 0)
    idle = seconds(F.length("text") < 0)
    found = []
    for rule in rules:
        condition = rule.rejects(F.col("text"))
        rejected, n = run(condition)
        found.append(Estimate(rule, max(seconds(condition) - idle, 1e-3), rejected / max(n, 1)))
    return sorted(found, key=lambda e: -e.worth)


def first_failed(rules: Sequence[Rule], text: Column) -> Column:
    """The name of the first rule that rejects, null if none does; later rules are not evaluated."""
    chain = F.lit(None).cast("string")
    for rule in reversed(rules):
        chain = F.when(rule.rejects(text), F.lit(rule.name)).otherwise(chain)
    return chain


def judged(df: DataFrame, rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """``df`` with ``failed_rule``; any column of that name is replaced."""
    order = [e.rule for e in estimate(df, rules)]
    return df.withColumn("failed_rule", first_failed(order, df["text"]))


def kept(df: DataFrame, rules: Sequence[Rule] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """The rows of ``df`` that no rule rejects, with its columns as they are."""
    order = [e.rule for e in estimate(df, rules)]
    return df.filter(first_failed(order, df["text"]).isNull())


def rule_report(df: DataFrame) -> DataFrame:
    """Base measures of every document, the base verdict and the cascade's."""
    text = F.col("text")
    order = [e.rule for e in estimate(df, MORE_RULES)]
    measured = df.select(
        "doc_id",
        "text",
        n_words(text).alias("n_words"),
        word_chars(text).alias("word_chars"),
        n_symbols(text).alias("n_symbols"),
        n_dup_lines(text).alias("n_dup_lines"),
        n_repeat_words(text).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    )
    judged_ = measured.withColumn("base_failed", failed).withColumn(
        "failed_rule", F.when(~failed, first_failed(order, text))
    )
    return judged_.select(
        *(c for c in measured.columns if c != "text"),
        "base_failed",
        (~F.col("base_failed") & F.col("failed_rule").isNull()).alias("kept"),
    )
