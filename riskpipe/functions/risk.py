"""Turning model output into risk levels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column
from pyspark.sql import functions as F

from riskpipe.functions.columns import literal

HIGH, MEDIUM, LOW = "HIGH", "MEDIUM", "LOW"


def class_probability(probability: Column, index: int) -> Column:
    """One element of a probability vector."""
    return vector_to_array(probability)[index]


def risk_band(probability: Column, high: float = 0.6, medium: float = 0.3) -> Column:
    """Band of a probability; both limits are exclusive. A null probability has no band."""
    return (
        F.when(probability.isNull(), F.lit(None).cast("string"))
        .when(probability > high, HIGH)
        .when(probability > medium, MEDIUM)
        .otherwise(LOW)
    )


def risk_from_label(
    prediction: Column,
    labels: Sequence[str],
    levels: Mapping[str, str] | None = None,
) -> Column:
    """Level of a predicted class index, looked up through the fitted label names.

    The index order depends on the training data (most frequent first), so the name decides:
    by default ``High`` and ``Medium`` keep their meaning and every other class is low.
    """
    levels = levels or {"high": HIGH, "medium": MEDIUM}
    named = F.array(*[F.lit(levels.get(label.lower(), LOW)) for label in labels])
    position = prediction.cast("int") + 1
    return F.when(prediction.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(F.try_element_at(named, position), F.lit(LOW))
    )


def missing_fields(fields: Mapping[str, str]) -> Column:
    """``'missing: a, b'`` naming the fields whose double value is null or NaN, else null.

    ``fields`` maps a name to the SQL text of its value.
    """
    if not fields:
        return F.lit(None).cast("string")
    names = ", ".join(
        f"IF({value} IS NULL OR isnan({value}), {literal(name)}, NULL)"
        for name, value in fields.items()
    )
    return F.expr(f"'missing: ' || nullif(concat_ws(', ', {names}), '')")
