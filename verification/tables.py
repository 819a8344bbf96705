"""Inputs derived from the driver tables: dirty rows, patient records, labelled training rows."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.operators import project_for
from riskpipe.sources import stage
from riskpipe.spec import SPECS, DatasetSpec
from verification.synthetic import synthesize_patients

DIRTY = DatasetSpec(
    "dirty_events",
    target="flag",
    categorical=("event_type",),
    numeric=("value_raw", "user_id", "bucket"),
    drop=("event_id",),
)

ORDERS = DatasetSpec(
    "orders",
    target="o_orderstatus",
    categorical=("o_orderpriority",),
    numeric=("o_totalprice", "o_custkey"),
    drop=("o_orderkey",),
    target_type="string",
)

LINES = DatasetSpec(
    "lines",
    target="l_returnflag",
    categorical=("l_linestatus",),
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    target_type="string",
)

#: Orders with their customer as a category, which is wide above so many values here.
WIDE_ORDERS = DatasetSpec(
    "wide_orders",
    target="o_orderstatus",
    categorical=("o_custkey", "o_orderpriority"),
    numeric=("o_totalprice",),
    drop=("o_orderkey",),
    target_type="string",
)
WIDE_FROM = 10
#: Many core counts divide it: files of one size are read by as many tasks as there are cores if that comes out even,
#: and else by a few more, for which all others wait.
FILES = 48
#: Records that one task makes.
TASK_RECORDS = 50_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, with cells made missing in every way and some rows repeated.

    The repeats come from one scan: each row is unfolded into as many copies as it should have.
    """
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "event_id",
            """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 'N/A'
                    WHEN event_id % 29 = 0 THEN '' ELSE CAST(value AS STRING) END AS value_raw""",
            """CASE WHEN event_id % 97 = 0 OR event_id % 13 = 0 THEN NULL
                    ELSE user_id END AS user_id""",
            """CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'N/A'
                    ELSE event_type END AS event_type""",
            "CASE WHEN event_id % 97 = 0 THEN NULL ELSE event_id % 12 END AS bucket",
            "event_id % 3 AS flag",
            "explode(sequence(1, IF(event_id % 50 = 0, 2, 1))) AS copy",
        )
        .drop("copy")
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One complete record per customer.

    A record takes far longer to make than its key to read, so the keys are dealt to tasks by their
    number: by the size of their files, one task could make all records.
    """
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    tasks = math.ceil(customers.count() / TASK_RECORDS)
    if tasks > 1:
        customers = customers.repartition(tasks)
    return synthesize_patients(customers, id_column="c_custkey")


def gappy_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with some measurements missing.

    Staged, as records come from files and not from hashes computed on the way; in ``FILES`` of
    them, so that not one task scores them all.
    """
    gaps = {
        "BMI": "IF(BMI > 45, NULL, BMI)",
        "avg_glucose_level": "IF(avg_glucose_level > 260, double('NaN'), avg_glucose_level)",
        "age_stroke": "IF(age_stroke < 25, NULL, age_stroke)",
        "smoking_status": "IF(smoking_status = 'Unknown', NULL, smoking_status)",
        "Snoring": "IF(Snoring = 7 AND Dry_Cough = 7, NULL, Snoring)",
    }
    records = patients(spark, sf_dir)
    gappy = records.selectExpr(*[f"{gaps.get(c, c)} AS {c}" for c in records.columns])
    return stage(gappy.repartition(FILES, "patient_id"))


def _points(*conditions: str) -> str:
    return " + ".join(f"IF({c}, 1, 0)" for c in conditions)


def training_rows(records: DataFrame, name: str) -> DataFrame:
    """A labelled table for one of the four datasets: its inputs plus a rule-made target."""
    spec = SPECS[name]
    heart = _points("HighBP = 1", "HighChol = 1", "Smoker = 1", "Stroke = 1", "Age > 9", "BMI > 35")
    diabetes = _points("HighBP = 1", "BMI > 33", "GenHlth > 3", "Age > 8")
    stroke = _points(
        "age_stroke > 60",
        "hypertension = 1",
        "avg_glucose_level > 180",
        "smoking_status = 'smokes'",
    )
    lung = "Air_Pollution + Smoking_lung + Genetic_Risk + Chest_Pain"
    target = {
        "heart": f"CAST({heart} >= 4 AS DOUBLE)",
        "diabetes": f"CAST({diabetes} >= 3 AS DOUBLE)",
        "stroke": f"CAST({stroke} >= 3 AS DOUBLE)",
        "lungcancer": f"CASE WHEN {lung} >= 22 THEN 'High' WHEN {lung} >= 16 THEN 'Medium' "
        "ELSE 'Low' END",
    }[name]
    labelled = records.withColumn("__target", F.expr(target))
    return project_for(labelled, spec, keep=["__target"]).withColumnRenamed("__target", spec.target)
