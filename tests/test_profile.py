import math
import random

import pytest

from riskpipe.operators import (
    column_stats,
    continuous_columns,
    distinct_counts,
    label_dictionary,
    modes,
    quantiles,
)

NAN = float("nan")
PROBS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]


def order_statistic(values, p):
    kept = sorted(v for v in values if v is not None and not math.isnan(v))
    return kept[max(1, math.ceil(round(p * len(kept), 9))) - 1]


def shapes():
    rng = random.Random(7)
    return {
        "spread": [rng.gauss(0, 100) for _ in range(3000)],
        "hot value": [5.0] * 1000 + [rng.random() for _ in range(1000)] + [9.0] * 1000,
        "two hot ends": [0.0] * 1400 + [rng.random() for _ in range(200)] + [1.0] * 1400,
        "gaps": [None, NAN] * 500 + [float(i) for i in range(2000)],
        "signed zero": [-0.0, 0.0] * 1000 + [float(i) for i in range(-500, 500)],
    }


@pytest.mark.parametrize("shape", shapes())
@pytest.mark.parametrize("few_values", [500_000, 20])
def test_exact_quantiles_are_order_statistics(spark, shape, few_values):
    """Also when narrowing has to go on down to a handful of values."""
    values = shapes()[shape]
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(5)
    got = quantiles(df, ["v"], PROBS, error=0, few_values=few_values)["v"]
    assert got == [order_statistic(values, p) for p in PROBS]


def test_exact_quantiles_of_many_columns(spark):
    columns = list(shapes().values())
    rows = list(zip(*[c[:3000] for c in columns]))
    names = [f"c {i}" for i in range(len(columns))]
    df = spark.createDataFrame(rows, ", ".join(f"`{n}` double" for n in names))
    got = quantiles(df, names, [0.25, 0.75], error=0, few_values=100)
    for i, name in enumerate(names):
        values = [row[i] for row in rows]
        assert got[name] == [order_statistic(values, 0.25), order_statistic(values, 0.75)]


def test_exact_agrees_with_spark_at_error_zero(spark):
    for n in (1, 2, 3, 4, 5, 10, 101):
        df = spark.range(n).selectExpr("double(id * 37 % 101) AS v")
        probs = [0.25, 0.5, 0.75]
        assert quantiles(df, ["v"], probs, 0)["v"] == df.approxQuantile("v", probs, 0.0)


def test_all_missing_and_empty_columns_have_no_quantiles(spark):
    df = spark.createDataFrame([(None, NAN, 1.0)] * 3, "a double, b double, c double")
    for error in (0, 0.01):
        got = quantiles(df, ["a", "b", "c"], [0.5], error)
        assert got == {"a": [], "b": [], "c": [1.0]}
    assert quantiles(df.limit(0), ["c"], [0.5], 0) == {"c": []}
    assert quantiles(df, [], [0.5], 0) == {}


def test_mode_ties_go_to_the_smallest_value(spark):
    rows = [("b", "N/A"), ("a", None), ("a", "N/A"), ("b", None), ("c", None)]
    df = spark.createDataFrame(rows, "x string, nothing string")
    got = {r["column_name"]: (r["mode_value"], r["n_rows"]) for r in modes(df, df.columns).collect()}
    assert got == {"x": ("a", 2)}


def test_distinct_counts_take_null_as_a_value(spark):
    df = spark.createDataFrame(
        [(1.0, "a", None), (NAN, "b", None), (NAN, None, None)], "a double, b string, c int"
    )
    got = {r["column_name"]: r["n_distinct"] for r in distinct_counts(df, df.columns).collect()}
    assert got == {"a": 2, "b": 3, "c": 1}
    empty = {r["n_distinct"] for r in distinct_counts(df.limit(0), df.columns).collect()}
    assert empty == {0}


def test_continuous_is_more_than_ten_values_at_the_edge(spark):
    df = spark.range(500).selectExpr(
        "double(id % 10) AS ten",
        "double(id % 11) AS eleven",
        "IF(id % 11 = 0, NULL, double(id % 11)) AS ten_and_null",
        "IF(id % 12 = 0, NULL, double(id % 12)) AS eleven_and_null",
        "double(id) AS many",
        "double(id % 22) AS near",
        "double(1) AS constant",
    )
    got = continuous_columns(df, [*df.columns, "absent"])
    assert got == ["eleven", "ten_and_null", "eleven_and_null", "many", "near"]
    assert continuous_columns(df, ["many", "near"], more_than=400) == ["many"]
    assert continuous_columns(df, ["many", "near"], more_than=5000) == []


def test_column_stats_leave_nulls_out(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (None,)], "`a b` double")
    row = column_stats(df, ["a b"]).first()
    assert (row["n_values"], row["mean"]) == (2, 2.0)
    assert row["std"] == pytest.approx(math.sqrt(2))


@pytest.mark.parametrize("window_rows", [1_000_000, 0])
def test_dictionary_orders_by_count_then_value(spark, window_rows):
    """The range-sorted numbering gives what the window gives."""
    rng = random.Random(3)
    rows = [(rng.choice("abcdefghij"), str(rng.randint(0, 400))) for _ in range(2000)]
    df = spark.createDataFrame(rows, "few string, many string")
    got = label_dictionary(df, ["few", "many"], window_rows).collect()
    for i, name in enumerate(("few", "many")):
        counts = {}
        for row in rows:
            counts[row[i]] = counts.get(row[i], 0) + 1
        want = sorted(counts, key=lambda v: (-counts[v], v))
        mine = sorted((r for r in got if r["column_name"] == name), key=lambda r: r["label_index"])
        assert [r["value"] for r in mine] == want
        assert [r["label_index"] for r in mine] == list(range(len(want)))


def test_exact_quantiles_with_infinities(spark):
    values = [float("-inf")] * 40 + [float(i) for i in range(100)] + [float("inf")] * 60
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = quantiles(df, ["v"], PROBS, error=0, few_values=10)["v"]
    assert got == [order_statistic(values, p) for p in PROBS]
