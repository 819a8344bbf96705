"""Statistics that describe columns: modes, distinct counts, moments, label dictionaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskpipe.functions.columns import as_double, col, present
from riskpipe.sources.staging import discard, stage, staging, staging_dir

WINDOW_ROWS = 1_000_000  # rows that one task may number
SKETCH_PROOF = 1_000  # largest limit for which a 4096-register sketch proves "more than"


def value_counts(df: DataFrame, cols: Sequence[str], ignore: Sequence[str] = ()) -> DataFrame:
    """``(column_name, value, n_rows)`` for the non-null values of all columns, in one shuffle.

    Values are compared as text.  Counts combine before the shuffle, so a hot value costs one row
    per task.
    """
    cells = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), col(name).cast("string").alias("value"))
            for name in cols
        ]
    )
    long = df.select(F.inline(cells)).filter(F.col("value").isNotNull())
    if ignore:
        long = long.filter(~F.col("value").isin(*ignore))
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))


def modes(df: DataFrame, cols: Sequence[str], ignore: Sequence[str] = ("N/A",)) -> DataFrame:
    """``(column_name, mode_value, n_rows)``; ties go to the smallest value.

    A column without any value has no row.
    """
    order = F.struct(-F.col("n_rows"), F.col("value"))
    return (
        value_counts(df, cols, ignore)
        .groupBy("column_name")
        .agg(F.min_by("value", order).alias("mode_value"), F.max("n_rows").alias("n_rows"))
    )


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, n_distinct)``, null counting as one value. Exact.

    One branch per column, each reading and shuffling that column alone: less than a single
    aggregate over all of them, which would carry every column in the key of every row.
    """
    counts = df.sparkSession.createDataFrame([], "column_name string, n_distinct long")
    for name in cols:
        one = (
            df.select(col(name).alias("value"))
            .distinct()
            .agg(F.count("*").alias("n_distinct"))
            .select(F.lit(name).alias("column_name"), "n_distinct")
        )
        counts = counts.unionByName(one)
    return counts


def continuous_columns(df: DataFrame, cols: Sequence[str], more_than: int = 10) -> list[str]:
    """The columns with more than ``more_than`` distinct values, null counting as one.

    A sketch settles the wide columns: k distinct values fill at most k of its registers, and in
    that range it returns k but for rounding, so an estimate above twice the limit proves the
    answer.  Only columns near or below the limit are counted exactly, on few distinct values.
    Limits beyond the sketch's proven range go straight to the exact count.
    """
    cols = present(df, cols)
    if not cols:
        return []
    wide = set()
    if more_than <= SKETCH_PROOF:
        estimates = [F.approx_count_distinct(col(c), 0.02).alias(f"n{i}") for i, c in enumerate(cols)]
        sketched = df.agg(*estimates).first()
        wide = {name for i, name in enumerate(cols) if sketched[f"n{i}"] > 2 * more_than + 2}
    narrow = [name for name in cols if name not in wide]
    if narrow:
        rows = distinct_counts(df, narrow).collect()
        wide |= {r["column_name"] for r in rows if r["n_distinct"] > more_than}
    return [name for name in cols if name in wide]


def column_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, n_values, mean, std)``: sample standard deviation, nulls left out."""
    wanted = []
    for i, name in enumerate(cols):
        wanted += [
            F.count(as_double(name)).alias(f"n{i}"),
            F.avg(as_double(name)).alias(f"mean{i}"),
            F.stddev_samp(as_double(name)).alias(f"std{i}"),
        ]
    return df.agg(*wanted).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("column_name"),
                        F.col(f"n{i}").alias("n_values"),
                        F.col(f"mean{i}").alias("mean"),
                        F.col(f"std{i}").alias("std"),
                    )
                    for i, name in enumerate(cols)
                ]
            )
        )
    )


def label_dictionary(
    df: DataFrame, cols: Sequence[str], window_rows: int = WINDOW_ROWS
) -> DataFrame:
    """``(column_name, value, n_rows, label_index)``: most frequent value first, ties by value.

    The value counts are staged, so their number is known before any of them is put in order: up
    to ``window_rows`` a window numbers them, beyond that a range sort does, into a table of its own.
    """
    order = [F.desc("n_rows"), F.asc("value")]
    folder = staging_dir(df.sparkSession)
    counts = stage(value_counts(df, cols), folder, "counts")
    if counts.count() <= window_rows:
        index = F.row_number().over(Window.partitionBy("column_name").orderBy(*order)) - 1
        return counts.withColumn("label_index", index.cast("long"))
    with staging(df.sparkSession) as work:
        numbered = stage(_numbered(counts, F.col("column_name"), order, work))
    discard(df.sparkSession, folder)
    return numbered


def _numbered(counts: DataFrame, group: Column, order: list[Column], work: str) -> DataFrame:
    """Number the rows of each group in order, with every task numbering one sorted range."""
    ranged = counts.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    # The staged ids hold the range number and the position within the range.
    placed = stage(ranged.withColumn("place", F.monotonically_increasing_id()), work, "placed")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy("column_name", part.alias("part")).agg(
        F.count("*").alias("rows"), F.min("place").alias("first_place")
    )
    # One row per group and range, so about as many as shuffle partitions: a window is safe here.
    earlier = Window.partitionBy("column_name").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = sizes.select(
        "column_name",
        "part",
        "first_place",
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("start"),
    )
    return (
        placed.withColumn("part", part)
        .join(F.broadcast(starts), ["column_name", "part"])
        .select(
            "column_name",
            "value",
            "n_rows",
            (F.col("start") + F.col("place") - F.col("first_place")).alias("label_index"),
        )
    )
