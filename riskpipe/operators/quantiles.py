"""Quantiles of many columns at once.

With an error above zero this is Spark's ``approxQuantile``: one pass, all columns together.

With error zero the exact order statistic is found by narrowing, not by sorting or by collecting
values: a sketch proposes two values around the wanted rank, a counting pass states exactly how
many rows lie below, between and above them, and the search goes on in the part that holds the
rank.  The counts decide, so the sketch affects the number of passes but never the result.  Once a
part holds few distinct values (measured, see ``FEW_VALUES``) their frequencies are accumulated in
order.  Only sketches and counts are shuffled before that point.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskpipe.functions.columns import as_double

FEW_VALUES = 100_000  # distinct values that one task may accumulate
SKETCH_K = 400  # KLL size: rank error below 1 % of the rows sketched
MARGIN = 0.01  # how far around the wanted rank the two proposed values are taken
MERGERS = 256  # tasks that merge sketches before the last merge

QUANTILE_SCHEMA = StructType(
    [
        StructField("column_name", StringType()),
        StructField("prob", DoubleType()),
        StructField("value", DoubleType()),
    ]
)


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    error: float = 0.01,
    few_values: int = FEW_VALUES,
) -> dict[str, list[float]]:
    """Quantiles per column, nulls and NaN left out; an all-missing column gives ``[]``."""
    if not cols:
        return {}
    numbers = df.select([as_double(name).alias(f"c{i}") for i, name in enumerate(cols)])
    if error > 0:
        found = numbers.approxQuantile(numbers.columns, list(probs), error)
        return dict(zip(cols, found))
    nothing = F.lit(None).cast("double")
    known = numbers.select([F.nanvl(c, nothing).alias(c) for c in numbers.columns])
    found = _exact(known, list(probs), few_values)
    return {name: found.get(f"c{i}", []) for i, name in enumerate(cols)}


def quantile_rank(prob: float, rows: int) -> int:
    """The rank, from 1, of the value that is a quantile of so many rows."""
    return max(1, math.ceil(Decimal(repr(float(prob))) * rows))


def quantile_table(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], error: float = 0.01
) -> DataFrame:
    """The same as a table ``(column_name, prob, value)``, one row per column and probability."""
    found = quantiles(df, cols, probs, error)
    rows = [
        (name, float(prob), value)
        for name, values in found.items()
        for prob, value in zip(probs, values)
    ]
    return df.sparkSession.createDataFrame(rows, QUANTILE_SCHEMA)


@dataclass(frozen=True)
class _Span:
    """The values of one column strictly between two limits; None is no limit."""

    column: str
    low: float | None = None
    high: float | None = None

    def inside(self) -> Column:
        cell = F.col(self.column)
        test = cell.isNotNull()
        if self.low is not None:
            test &= cell > self.low
        if self.high is not None:
            test &= cell < self.high
        return test

    def values(self) -> Column:
        cell = F.col(self.column)
        return cell if self.low is None and self.high is None else F.when(self.inside(), cell)


@dataclass
class _Search:
    """Where the value of a rank lies: ranks count all of the column's values, from 1."""

    rank: int
    span: _Span
    before: int  # values below the span
    rows: int  # values in the span


def _exact(df: DataFrame, probs: list[float], few_values: int) -> dict[str, list[float]]:
    counted = df.agg(*[F.count(name).alias(name) for name in df.columns]).first()
    answers: dict[tuple[str, float], float] = {}
    searches: dict[tuple[str, float], _Search] = {}
    for name in df.columns:
        for prob in probs:
            if counted[name]:
                rank = quantile_rank(prob, counted[name])
                searches[name, prob] = _Search(rank, _Span(name), 0, counted[name])

    few: dict[tuple[str, float], _Search] = {}
    while searches:
        # Many rows may still be few values.
        large = {s.span for s in searches.values() if s.rows > few_values}
        values = _distinct(df, list(large))
        for key, search in list(searches.items()):
            if values.get(search.span, 0) <= few_values:
                few[key] = searches.pop(key)
        if searches:
            answers |= _narrow(df, searches)
    answers |= _accumulate(df, few)
    return {
        name: [answers[name, prob] for prob in probs]
        for name in df.columns
        if all((name, prob) in answers for prob in probs)
    }


def _distinct(df: DataFrame, spans: list[_Span]) -> dict[_Span, int]:
    """Estimated distinct values of each span, in one pass."""
    if not spans:
        return {}
    wanted = [F.approx_count_distinct(s.values()).alias(f"n{i}") for i, s in enumerate(spans)]
    return dict(zip(spans, df.agg(*wanted).first()))


def _narrow(
    df: DataFrame, searches: dict[tuple[str, float], _Search]
) -> dict[tuple[str, float], float]:
    """Shrink every search in place; take out and return the ones that hit their value."""
    # Propose: sketches merge in two steps, so that no task receives one from every task.
    spans = list({search.span for search in searches.values()})
    sketched = df.groupBy((F.spark_partition_id() % MERGERS).alias("part")).agg(
        *[
            F.kll_sketch_agg_double(span.values(), SKETCH_K).alias(f"s{i}")
            for i, span in enumerate(spans)
        ]
    )
    merged = sketched.agg(
        *[F.kll_merge_agg_double(f"s{i}", SKETCH_K).alias(f"s{i}") for i in range(len(spans))]
    )
    proposals = []
    for search in searches.values():
        at = (search.rank - search.before) / search.rows
        pair = F.array(F.lit(max(0.0, at - MARGIN)), F.lit(min(1.0, at + MARGIN)))
        sketch = f"s{spans.index(search.span)}"
        proposals.append(F.kll_sketch_get_quantile_double(sketch, pair))
    limits = merged.select(*[p.alias(f"q{i}") for i, p in enumerate(proposals)]).first()

    # Count exactly: values below and up to either proposed value.
    wanted = []
    for search, (low, high) in zip(searches.values(), limits):
        cell = F.col(search.span.column)
        for test in (cell < low, cell <= low, cell < high, cell <= high):
            wanted.append(F.count_if(test).alias(f"n{len(wanted)}"))
    counts = df.agg(*wanted).first()

    hits = {}
    for i, (key, search) in enumerate(list(searches.items())):
        low, high = limits[i]
        below_low, upto_low, below_high, upto_high = counts[4 * i : 4 * i + 4]
        span, end = search.span, search.before + search.rows
        if below_low < search.rank <= upto_low:
            hits[key] = low
            del searches[key]
        elif below_high < search.rank <= upto_high:
            hits[key] = high
            del searches[key]
        elif search.rank <= below_low:
            search.span = _Span(span.column, span.low, low)
            search.rows = below_low - search.before
        elif search.rank > upto_high:
            search.span = _Span(span.column, high, span.high)
            search.before, search.rows = upto_high, end - upto_high
        else:
            search.span = _Span(span.column, low, high)
            search.before, search.rows = upto_low, below_high - upto_low
    return hits


def _accumulate(
    df: DataFrame, searches: dict[tuple[str, float], _Search]
) -> dict[tuple[str, float], float]:
    """Read ranks off the ordered value frequencies of spans with few distinct values.

    Every span is counted by a branch of its own, which reads just the span's column.
    """
    wanted: dict[_Span, list[int]] = {}
    for search in searches.values():
        wanted.setdefault(search.span, []).append(search.rank - search.before)
    spans = list(wanted)
    hits = None
    for i, span in enumerate(spans):
        ranks = F.array(*[F.lit(rank).cast("long") for rank in wanted[span]])
        counted = (
            df.filter(span.inside())
            .groupBy(F.col(span.column).alias("value"))
            .agg(F.count("*").alias("n"))
            .select(F.lit(i).alias("span"), "value", "n", ranks.alias("ranks"))
        )
        hits = counted if hits is None else hits.unionByName(counted)
    if hits is None:
        return {}
    upto = Window.partitionBy("span").orderBy("value")
    rows = (
        hits.withColumn("last", F.sum("n").over(upto))
        .withColumn("ranks", F.expr("filter(ranks, r -> r <= last AND r > last - n)"))
        .filter(F.size("ranks") > 0)
        .select("span", "value", "ranks")
        .collect()
    )
    at = {(spans[row["span"]], rank): row["value"] for row in rows for rank in row["ranks"]}
    return {key: at[s.span, s.rank - s.before] for key, s in searches.items()}
