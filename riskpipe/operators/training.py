"""Splits, forests and fitted risk models."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.functions.columns import col
from riskpipe.operators.features import FEATURES, LABEL, target_labels
from riskpipe.operators.wide import TableIndexerModel
from riskpipe.spec import DatasetSpec

TRAINING, TRAINING_FOLDER = "train_rows long, parts long", "training"
#: From so many levels on, a row keeps its node of every tree from one pass to the next.
DEEP = 8


def train_flag(key: Sequence[str], train: float = 0.8, seed: int = 42) -> Column:
    """Whether a row belongs to the training part, decided by a hash of its key alone."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in key]))
    bucket = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 100
    return bucket < round(train * 100)


def split(
    df: DataFrame, key: Sequence[str] | None = None, train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows.

    With a key the parts depend on the rows alone, so they neither overlap nor move when the
    table is repartitioned or a lost partition is computed again.  Without one it is Spark's
    ``randomSplit``, which depends on the partitioning.
    """
    if key is None:
        train_rows, test_rows = df.randomSplit([train, 1.0 - train], seed=seed)
        return train_rows, test_rows
    flag = train_flag(key, train, seed)
    return df.filter(flag), df.filter(~flag)


def forest(
    trees: int = 100,
    depth: int = 10,
    bins: int = 32,
    seed: int = 42,
    memory_mb: int = 256,
) -> RandomForestClassifier:
    """The classifier. More ``memory_mb`` lets one pass over the data grow more nodes.

    Every pass would walk each tree from its root for every row; deep ones take up where the pass
    before stopped. That costs four bytes a row and tree of cache, and gives the same trees.
    """
    return RandomForestClassifier(
        labelCol=LABEL,
        featuresCol=FEATURES,
        numTrees=trees,
        maxDepth=depth,
        maxBins=bins,
        seed=seed,
        maxMemoryInMB=memory_mb,
        cacheNodeIds=depth >= DEEP,
    )


@dataclass(frozen=True)
class RiskModel:
    """Everything needed to score a dataset: one fitted pipeline and its spec."""

    spec: DatasetSpec
    pipeline: PipelineModel
    train_rows: int | None = None  # that the forest was grown on,
    parts: int | None = None  # and into how many parts they were dealt

    @property
    def forest(self) -> RandomForestClassificationModel:
        return self.pipeline.stages[-1]

    @property
    def labels(self) -> list[str] | None:
        return target_labels(self.pipeline)

    def predict(self, features: DataFrame) -> DataFrame:
        """Add rawPrediction, probability and prediction to a feature table."""
        return self.forest.transform(features)


def save_model(model: RiskModel, path: str) -> None:
    """Replace the model at ``path``, also by one that was loaded from there."""
    stages = [s.detached() if isinstance(s, TableIndexerModel) else s for s in model.pipeline.stages]
    PipelineModel(stages).write().overwrite().save(path)
    if model.parts:
        rows = SparkSession.builder.getOrCreate().createDataFrame([(model.train_rows, model.parts)], TRAINING)
        rows.coalesce(1).write.mode("overwrite").json(f"{path}/{TRAINING_FOLDER}")


def load_model(path: str, spec: DatasetSpec) -> RiskModel:
    spark = SparkSession.builder.getOrCreate()
    pipeline = PipelineModel.load(path)
    notes = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{TRAINING_FOLDER}")
    if not notes.getFileSystem(spark._jsc.hadoopConfiguration()).exists(notes):
        return RiskModel(spec, pipeline)
    noted = spark.read.schema(TRAINING).json(f"{path}/{TRAINING_FOLDER}").first()
    return RiskModel(spec, pipeline, noted["train_rows"], noted["parts"])


def top_features(spark: SparkSession, model: RiskModel, k: int = 5) -> DataFrame:
    """``(feature, importance)`` of the k most important features, by name."""
    weights = model.forest.featureImportances.toArray()
    rows = [(name, float(weight)) for name, weight in zip(model.spec.features, weights)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(k)
