"""Evaluations that are kept and added to.

A model's quality follows from how often each label got each prediction, and such counts add up.  So
every evaluated part of the test rows leaves its confusion counts, a few rows, in a table below one
folder, ``<root>/<name>/<part>``; the report comes from their sum.  New test rows are scored once, as
a part of their own, and none of the old ones again; a part that is evaluated again replaces itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.operators.features import LABEL
from riskpipe.operators.metrics import classification_metrics, confusion

METRICS = ("accuracy", "precision", "recall", "f1_score")
PART_SCHEMA = "disease string, part string, label double, prediction double, n_rows long, train_rows long"


def add_evaluation(
    predictions: DataFrame, root: str, name: str, part: str, train_rows: int = 0, label: str = LABEL
) -> None:
    """Keep the confusion counts of ``predictions`` as a part of the evaluation of ``name``.

    ``train_rows`` are the rows that this part adds to those the model was trained on.
    """
    counts = confusion(predictions, label).withColumn("train_rows", F.lit(0).cast("long"))
    rows = predictions.sparkSession.createDataFrame(
        [(None, None, 0, train_rows)], "label double, prediction double, n_rows long, train_rows long"
    )
    named = counts.unionByName(rows).select(
        F.lit(name).alias("disease"), F.lit(part).alias("part"), "label", "prediction", "n_rows", "train_rows"
    )
    named.coalesce(1).write.mode("overwrite").parquet(f"{root}/{name}/{part}")


def evaluation_parts(spark: SparkSession, root: str) -> DataFrame:
    """``(disease, part, label, prediction, n_rows, train_rows)`` of all parts below ``root``."""
    reader = spark.read.schema(PART_SCHEMA).option("recursiveFileLookup", True)
    return reader.parquet(root)


def evaluation_of_parts(spark: SparkSession, root: str) -> DataFrame:
    """``(disease, accuracy, precision, recall, f1_score, train_rows, test_rows)`` of what is kept."""
    parts = evaluation_parts(spark, root)
    counts = parts.filter("n_rows > 0")
    trained = parts.groupBy("disease").agg(F.sum("train_rows").alias("train_rows"))
    scored = classification_metrics(counts, ["disease"]).withColumnRenamed("n_rows", "test_rows")
    return trained.join(scored, "disease", "left").select(
        "disease", *METRICS, "train_rows", F.coalesce("test_rows", F.lit(0).cast("long")).alias("test_rows")
    )
