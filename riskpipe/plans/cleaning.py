"""The cleaning chain and its report."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.functions.missing import missing_cells
from riskpipe.operators.profile import continuous_columns
from riskpipe.operators.quality import (
    completeness_limit,
    drop_duplicate_rows,
    drop_ids,
    fill_missing,
    medians,
    mode_values,
    outlier_conditions,
    to_double,
    validate_schema,
)
from riskpipe.sources.staging import staging, staging_dir
from riskpipe.sources.tables import read_raw, write_report, write_table
from riskpipe.spec import DatasetSpec

STAGES = ("original", "complete", "within_bounds", "final")
MISSING_CELLS = "__missing_cells"
CONTINUOUS_OVER = 10  # distinct values above which a column is checked for outliers


@dataclass(frozen=True)
class CleanResult:
    """A clean table and what was done to get it."""

    table: DataFrame
    counts: DataFrame  # (disease, stage, n_rows)
    report: DataFrame  # one row, see quality_report
    schema: DataFrame  # see validate_schema
    medians: Mapping[str, float]
    modes: Mapping[str, str]
    continuous: tuple[str, ...]


def clean(
    df: DataFrame,
    spec: DatasetSpec,
    path: str | None = None,
    error: float = 0.01,
    sequential: bool = True,
    max_missing: float = 0.5,
) -> CleanResult:
    """Clean a raw table: ids and casts, sparse rows, imputation, outliers, duplicates.

    The cast table is written once, with the row's count of missing cells as a column: the passes
    that follow then read just the columns they need.  The clean table goes to ``path``, or to a
    table that lasts as long as the application; the cast table is deleted.

    One aggregate over the cast table counts the rows at each stage; those of the clean table are
    in its files' footers.  Metrics collected on the way are not used: they may count a partition
    twice when a lost executor's work is repeated.
    """
    spark = df.sparkSession
    typed = to_double(drop_ids(df, spec), spec.numeric)
    limit = completeness_limit(len(typed.columns), max_missing)
    schema = validate_schema(typed, spec)

    counted = typed.withColumn(MISSING_CELLS, missing_cells(typed, spec.missing_tokens))
    path = path or f"{staging_dir(spark)}/clean"
    with staging(spark) as work:
        counted.write.parquet(f"{work}/typed")
        staged = spark.read.schema(counted.schema).parquet(f"{work}/typed")
        few_gaps = F.col(MISSING_CELLS) <= limit
        complete = staged.filter(few_gaps).drop(MISSING_CELLS)

        median_of = medians(complete, spec.numeric, error)
        mode_of = mode_values(complete, spec.categorical, spec.fill_tokens)
        filled = fill_missing(complete, median_of, mode_of, spec.fill_tokens)
        continuous = continuous_columns(filled, spec.numeric, CONTINUOUS_OVER)
        within = reduce(
            and_, outlier_conditions(filled, continuous, sequential=sequential, error=error), F.lit(True)
        )
        write_table(drop_duplicate_rows(filled.filter(within)), path)

        rows = fill_missing(staged, median_of, mode_of, spec.fill_tokens).agg(
            F.count("*"), F.count_if(few_gaps), F.count_if(few_gaps & within)
        )
        sizes = [*rows.first()]
    table = spark.read.schema(filled.schema).parquet(path)
    counts = stage_counts(spark, spec.name, dict(zip(STAGES, [*sizes, table.count()], strict=True)))
    return CleanResult(
        table,
        counts,
        quality_report(counts, len(spec.columns)),
        schema,
        median_of,
        mode_of,
        tuple(continuous),
    )


def stage_counts(spark: SparkSession, name: str, rows: Mapping[str, int]) -> DataFrame:
    """``(disease, stage, n_rows)`` from the rows counted at each stage."""
    return spark.createDataFrame(
        [(name, stage_name, n) for stage_name, n in rows.items()],
        "disease string, stage string, n_rows long",
    )


def quality_report(counts: DataFrame, column_count: int) -> DataFrame:
    """Rows removed by each step, rows kept, and the share kept, per dataset."""
    rows = {
        name: F.max(F.when(F.col("stage") == name, F.col("n_rows"))).alias(name)
        for name in STAGES
    }
    kept = F.when(
        F.col("original") > 0, F.round(F.col("final") / F.col("original") * 100, 1)
    )
    return (
        counts.groupBy("disease")
        .agg(*rows.values())
        .select(
            "disease",
            F.col("original").alias("original_rows"),
            (F.col("original") - F.col("complete")).alias("null_rows_removed"),
            (F.col("complete") - F.col("within_bounds")).alias("outlier_rows_removed"),
            (F.col("within_bounds") - F.col("final")).alias("duplicate_rows_removed"),
            F.col("final").alias("final_rows"),
            F.lit(column_count).cast("long").alias("column_count"),
            kept.alias("retained_pct"),
        )
    )


REPORT_COLUMNS = (
    "disease",
    "original_rows",
    "null_rows_removed",
    "outlier_rows_removed",
    "duplicate_rows_removed",
    "final_rows",
    "column_count",
)


def clean_all(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    raw_paths: Mapping[str, str],
    clean_root: str,
    report_path: str | None = None,
    error: float = 0.01,
) -> DataFrame:
    """Clean every raw CSV table into ``<clean_root>/<name>``; return and write the report."""
    report = quality_report(stage_counts(spark, "", {}), 0)
    for name, path in raw_paths.items():
        spec = specs[name]
        done = clean(read_raw(spark, path, spec), spec, f"{clean_root}/{name}", error)
        report = report.unionByName(done.report)
    if report_path:
        write_report(report.select(*REPORT_COLUMNS), report_path)
    return report
