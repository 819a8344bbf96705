import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType

from riskpipe.functions import (
    as_double,
    col,
    is_missing,
    literal,
    missing_cells,
    missing_fields,
    risk_band,
    risk_from_label,
)
from riskpipe.operators import drop_sparse_rows
from riskpipe.operators.quality import completeness_limit

NAN = float("nan")


def test_names_with_blanks_dots_and_ticks(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`a b` int, `c.d` int, `e``f` int")
    assert df.select(col("a b"), col("c.d"), col("e`f")).first() == (1, 2, 3)


def test_literals_survive_quotes_and_backslashes(spark):
    for text in ("it's", "back\\slash", "N/A", ""):
        assert spark.range(1).select(F.expr(literal(text))).first()[0] == text


def test_lenient_cast_gives_null_under_ansi(spark):
    rows = [("1.5",), ("N/A",), ("",), (None,), (" 2 ",), ("x1",)]
    df = spark.createDataFrame(rows, "v string")
    got = [r[0] for r in df.select(as_double("v")).collect()]
    assert got == [1.5, None, None, None, 2.0, None]


def test_missing_predicate_matches_the_loose_comparison_without_ansi(spark):
    """The typed predicate agrees with the untyped one that only runs with ANSI off."""
    texts = [(t,) for t in ("N/A", "", None, "x", "NaN", " nan ", "n/a", "0", " ")]
    numbers = [(n,) for n in (NAN, None, 0.0, 1.5)]
    whole = [(n,) for n in (None, 0, 7)]
    loose = "CASE WHEN v IS NULL OR isnan(v) OR v = 'N/A' OR v = '' THEN 1 ELSE 0 END"
    for rows, ddl, dtype in (
        (texts, "v string", StringType()),
        (numbers, "v double", DoubleType()),
        (whole, "v long", LongType()),
    ):
        df = spark.createDataFrame(rows, ddl)
        ours = [r[0] for r in df.select(is_missing("v", dtype).cast("int")).collect()]
        ansi = spark.conf.get("spark.sql.ansi.enabled")
        spark.conf.set("spark.sql.ansi.enabled", "false")
        try:
            theirs = [r[0] for r in df.selectExpr(loose).collect()]
        finally:
            spark.conf.set("spark.sql.ansi.enabled", ansi)
        assert ours == theirs, ddl


def test_missing_cells_counts_every_column_and_encoding(spark):
    df = spark.createDataFrame(
        [(None, NAN, "N/A", 1), (1.0, 2.0, "", None), (1.0, 2.0, "Unknown", 3)],
        "a double, b double, c string, d long",
    )
    assert [r[0] for r in df.select(missing_cells(df)).collect()] == [3, 2, 0]


def test_odd_column_count_rounds_the_limit_down(spark):
    assert [completeness_limit(n) for n in (22, 22, 11, 24, 5)] == [11, 11, 5, 12, 2]
    df = spark.createDataFrame(
        [(1.0, None, None, 1.0, 1.0), (None, None, None, 1.0, 1.0)],
        "a double, b double, c double, d double, e double",
    )
    assert drop_sparse_rows(df).count() == 1


@pytest.mark.parametrize(
    ("p", "risk"),
    [(0.3, "LOW"), (0.30001, "MEDIUM"), (0.6, "MEDIUM"), (0.60001, "HIGH"), (0.0, "LOW"), (None, None)],
)
def test_band_limits_are_exclusive(spark, p, risk):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(risk_band(F.col("p"))).first()[0] == risk


def test_label_name_decides_not_its_index(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,), (None,)], "p double")
    by_frequency = df.select(risk_from_label(F.col("p"), ["High", "Medium", "Low"])).collect()
    assert [r[0] for r in by_frequency] == ["HIGH", "MEDIUM", "LOW", "LOW", None]
    tied = df.select(risk_from_label(F.col("p"), ["High", "Low", "Medium"])).collect()
    assert [r[0] for r in tied] == ["HIGH", "LOW", "MEDIUM", "LOW", None]


def test_missing_fields_names_nulls_and_nans_in_order(spark):
    df = spark.createDataFrame([(1.0, 1.0), (None, NAN), (1.0, NAN)], "a double, b double")
    got = [r[0] for r in df.select(missing_fields({"A": "a", "B": "b"})).collect()]
    assert got == [None, "missing: A, B", "missing: B"]
