"""CSV, Parquet and JSON tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from riskpipe.spec import RECORD_SCHEMA, DatasetSpec


def csv_schema(spark: SparkSession, path: str, spec: DatasetSpec) -> StructType:
    """Schema of a raw CSV table from its header line and the spec, without a pass over the data.

    All columns are read as text: the lenient cast that follows decides what is a number.  A target
    of the spec's type ``double`` is read as such only if no cell of it says otherwise, which one
    scan of that column settles; else it stays text, to be indexed as classes.
    """
    header = spark.read.option("header", True).csv(path).columns
    types = dict.fromkeys(header, StringType())
    if spec.target_type != "string" and spec.target in types:
        schema = StructType([StructField(name, kind) for name, kind in types.items()])
        cell = F.col(f"`{spec.target}`")
        value = F.when(~F.trim(cell).isin("", *spec.missing_tokens), cell)
        odd = F.count_if(value.isNotNull() & value.try_cast("double").isNull())
        rows = spark.read.option("header", True).schema(schema).csv(path)
        if not rows.agg(odd).first()[0]:
            types[spec.target] = DoubleType()
    return StructType([StructField(name, kind) for name, kind in types.items()])


def read_raw(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Read a CSV table with a header.

    The schema is the one given, else the one the spec implies, else inferred, which costs a
    second pass over the files.  ``nullValue`` stays unset: tokens are the missing predicate's
    business, and setting it would turn empty cells into empty text.
    """
    reader = spark.read.option("header", True)
    if schema is None and spec is not None:
        schema = csv_schema(spark, path, spec)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    # enforceSchema=False makes each file's header be checked against the schema.
    return reader.option("enforceSchema", False).schema(schema).csv(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str) -> None:
    """Replace the Parquet table at ``path``. Serves clean and feature tables alike."""
    df.write.mode("overwrite").parquet(path)


def write_report(df: DataFrame, path: str) -> None:
    """Replace the CSV report at ``path`` with a single file.

    For reports of a few rows only; one task writes it.
    """
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = RECORD_SCHEMA,
    max_files_per_trigger: int | None = 1,
    corrupt: str | None = None,
) -> DataFrame:
    """Stream the JSON records that arrive in ``path``.

    A line that does not parse is a record of nulls.  With ``corrupt``, the name of a column, such a
    line stands there as text, and ``file`` names the file of every record.

    ``max_files_per_trigger=None`` takes all waiting files in one batch.  Scoring keeps no state
    between batches, so the results are the same; only the throughput differs.
    """
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if not corrupt:
        return reader.json(path)
    wider = StructType([*schema, StructField(corrupt, StringType())])
    records = reader.schema(wider).option("columnNameOfCorruptRecord", corrupt).json(path)
    return records.select("*", F.col("_metadata.file_path").alias("file"))
