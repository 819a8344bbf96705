"""Column references and casts.

Expressions over many columns are written as SQL text: one parsed text per column plans several
times faster than a tree of Python column objects.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quoted(name: str) -> str:
    """A column name as SQL text; it may hold spaces or dots."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A text as a SQL literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def col(name: str) -> Column:
    return F.col(quoted(name))


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that the frame has, in the given order (case-sensitive)."""
    have = set(df.columns)
    return [name for name in names if name in have]


def as_double(name: str) -> Column:
    """Cast to double; text that is no number becomes null, also under ANSI mode."""
    return F.expr(f"try_cast({quoted(name)} AS DOUBLE)")
