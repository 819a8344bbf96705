"""The missing-cell predicate.

A cell is missing when it is null, NaN, or one of the spec's tokens.  The predicate is chosen by
column type: comparing a number with a text token, or asking ``isnan`` of a text, would raise under
ANSI mode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

from riskpipe.functions.columns import literal, quoted


def missing_test(name: str, dtype: DataType, tokens: Sequence[str] = ("N/A", "")) -> str:
    """The predicate as SQL text; never null."""
    cell = quoted(name)
    if isinstance(dtype, (DoubleType, FloatType)):
        return f"({cell} IS NULL OR isnan({cell}))"
    if isinstance(dtype, StringType):
        # The text "NaN" reads as a number that is NaN, in any case and with outer blanks.
        texts = "".join(f" OR {cell} = {literal(token)}" for token in tokens)
        return f"({cell} IS NULL{texts} OR lower(trim({cell})) = 'nan')"
    return f"({cell} IS NULL)"


def is_missing(name: str, dtype: DataType, tokens: Sequence[str] = ("N/A", "")) -> Column:
    return F.expr(missing_test(name, dtype, tokens))


def missing_cells(df: DataFrame, tokens: Sequence[str] = ("N/A", "")) -> Column:
    """Number of missing cells in the row, over all columns of ``df``."""
    tests = [missing_test(f.name, f.dataType, tokens) for f in df.schema]
    return F.expr(" + ".join(f"IF({test}, 1, 0)" for test in tests))
