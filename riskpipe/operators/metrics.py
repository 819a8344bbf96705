"""Classification quality from one confusion table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, n_rows)``."""
    return df.groupBy(
        F.col(label).cast("double").alias("label"),
        F.col(prediction).cast("double").alias("prediction"),
    ).agg(F.count("*").alias("n_rows"))


def _ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)


def classification_metrics(confused: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row ``(accuracy, precision, recall, f1_score, n_rows)``, weighted by class size.

    With ``by`` a row for each value of those columns, which come first.  Cells may be given in
    parts: those of one label and prediction add up.
    Each confusion cell counts once for the class it is and once for the class it was taken for;
    per-class sums of these need no join.
    """
    n = F.col("n_rows")
    zero = F.lit(0).cast("long")
    right = F.when(F.col("label") == F.col("prediction"), n).otherwise(zero)
    sides = F.array(
        F.struct(
            F.col("label").alias("class"),
            n.alias("actual"),
            zero.alias("predicted"),
            right.alias("right"),
        ),
        F.struct(
            F.col("prediction").alias("class"),
            zero.alias("actual"),
            n.alias("predicted"),
            zero.alias("right"),
        ),
    )
    precision = _ratio(F.col("right"), F.col("predicted"))
    recall = _ratio(F.col("right"), F.col("actual"))
    per_class = (
        confused.select(*by, F.inline(sides))
        .groupBy(*by, "class")
        .agg(*[F.sum(name).alias(name) for name in ("actual", "predicted", "right")])
        .select(*by, "actual", "right", precision.alias("precision"), recall.alias("recall"))
        .withColumn(
            "f1",
            _ratio(
                2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")
            ),
        )
    )
    total = F.sum("actual")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * F.col("actual")) / total

    return per_class.groupBy(*by).agg(
        (F.sum("right") / total).alias("accuracy"),
        weighted("precision").alias("precision"),
        weighted("recall").alias("recall"),
        weighted("f1").alias("f1_score"),
        total.alias("n_rows"),
    )
