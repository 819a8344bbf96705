"""Feature tables, training and the evaluation report."""

from __future__ import annotations

import logging
import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.operators.features import (
    FEATURES,
    LABEL,
    MAX_LABELS,
    featurize,
    fit_features,
    has_target,
)
from riskpipe.operators.metrics import classification_metrics, confusion
from riskpipe.operators.quality import to_double
from riskpipe.operators.training import RiskModel, forest, save_model, split, train_flag
from riskpipe.plans.evaluation import METRICS, add_evaluation
from riskpipe.sources.staging import stage, staging
from riskpipe.sources.tables import read_table, write_report, write_table
from riskpipe.spec import DatasetSpec

log = logging.getLogger(__name__)

IS_TRAIN, ROW_HASH = "is_train", "row_hash"
#: Training rows and bytes of their features for a part (see ``training_parts``).
PART_ROWS, PART_BYTES, FEW_PARTS = 1_000, 128 << 20, 32
#: Datasets that are trained at a time.
AT_ONCE = 4

T = TypeVar("T")


@dataclass(frozen=True)
class TrainResult:
    model: RiskModel
    predictions: DataFrame  # the test rows with rawPrediction, probability and prediction
    metrics: Mapping[str, float]
    train_rows: int
    test_rows: int
    rows_without_target: int


def training_parts(rows: int, features: int) -> int:
    """How many parts so many training rows are dealt into.

    A forest's draws depend on it, so it follows from the rows alone and not from the cluster: a part
    for every ``PART_ROWS`` up to ``FEW_PARTS`` of them, and never more than ``PART_BYTES`` of features
    in a part, which is what a task holds of them while it grows trees.
    """
    small = min(FEW_PARTS, math.ceil(rows / PART_ROWS))
    return max(1, small, math.ceil(rows * (features + 1) * 8 / PART_BYTES))


def marked(
    df: DataFrame,
    spec: DatasetSpec,
    split_by: str,
    key: Sequence[str] | None,
    train_share: float,
    seed: int,
) -> DataFrame:
    """The spec's columns, numbers as such, with ``is_train`` and a hash of the row."""
    if split_by not in ("hash", "random"):
        raise ValueError("split_by is 'hash' or 'random'")
    columns = [f"`{name}`" for name in spec.columns]
    df = df.withColumn(ROW_HASH, F.xxhash64(*columns))
    if split_by == "hash":
        df = df.withColumn(IS_TRAIN, train_flag(key or spec.columns, train_share, seed))
        return to_double(df.select(*columns, IS_TRAIN, ROW_HASH), spec.numeric)
    df = to_double(df.select(*columns, ROW_HASH), spec.numeric)
    parts = split(df, None, train_share, seed)
    return parts[0].withColumn(IS_TRAIN, F.lit(True)).unionByName(
        parts[1].withColumn(IS_TRAIN, F.lit(False))
    )


def featurize_all(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    clean_root: str,
    feature_root: str,
    train_share: float = 0.8,
    seed: int = 42,
) -> dict[str, PipelineModel]:
    """Write ``<feature_root>/<name>`` tables ``(label, features, is_train, row_hash)``.

    The fitted stages are saved beside them, as ``<name>.stages``: ``train_from_features`` and
    scoring need both.
    """
    models = {}
    for name, spec in specs.items():
        rows = marked(
            read_table(spark, f"{clean_root}/{name}"), spec, "hash", None, train_share, seed
        )
        models[name] = fit_features(rows, spec)
        write_table(featurize(rows, spec, models[name], keep=[IS_TRAIN, ROW_HASH]), f"{feature_root}/{name}")
        models[name].write().overwrite().save(f"{feature_root}/{name}.stages")
    return models


def train(
    df: DataFrame,
    spec: DatasetSpec,
    fit_on: str = "all",
    split_by: str = "hash",
    classifier: RandomForestClassifier | None = None,
    train_share: float = 0.8,
    seed: int = 42,
    split_key: Sequence[str] | None = None,
    partitions: int | None = None,
    max_labels: int = MAX_LABELS,
) -> TrainResult:
    """Fit features and forest on a clean table and evaluate on the held-out rows.

    ``fit_on="all"`` fits indexers and scaler on every row, ``"train"`` on the training rows only,
    so that nothing leaks from the test rows.  ``split_by="hash"`` splits on a hash of
    ``split_key``, or of the whole row, which is unique in a de-duplicated table; ``"random"`` is
    Spark's ``randomSplit``.  Categories with more than ``max_labels`` values are indexed by a
    joined table.  ``partitions`` overrides ``training_parts``.
    """
    if fit_on not in ("all", "train"):
        raise ValueError("fit_on is 'all' or 'train'")
    rows = marked(df, spec, split_by, split_key, train_share, seed)
    with staging(df.sparkSession) as work:
        if fit_on == "train":
            rows = stage(rows, work, "marked")
            fitted = fit_features(rows.filter(IS_TRAIN), spec, max_labels)
        else:
            fitted = fit_features(rows, spec, max_labels)
        # One pass makes the features of both parts: a narrow table without lineage.
        features = stage(featurize(rows, spec, fitted, keep=[IS_TRAIN, ROW_HASH]), work, "features")
        return _grow(features, spec, fitted, classifier, partitions, rows)


def train_from_features(
    features: DataFrame,
    spec: DatasetSpec,
    fitted: PipelineModel,
    classifier: RandomForestClassifier | None = None,
    partitions: int | None = None,
) -> TrainResult:
    """Fit a forest on a table and stages that ``featurize_all`` wrote. Equal to ``train``."""
    return _grow(features, spec, fitted, classifier, partitions)


def _grow(
    features: DataFrame,
    spec: DatasetSpec,
    fitted: PipelineModel,
    classifier: RandomForestClassifier | None,
    partitions: int | None,
    source: DataFrame | None = None,
) -> TrainResult:
    train_rows, test_rows = (features.filter(F.col(IS_TRAIN) == part) for part in (True, False))
    # one aggregate over the one column of the staged features tells how to deal them
    n_train = features.agg(F.count_if(IS_TRAIN)).first()[0]
    parts = partitions or training_parts(n_train, len(spec.features))
    lost = 0 if source is None else source.agg(F.count_if(~has_target(source, spec))).first()[0]
    if lost:
        log.warning("%s: %d rows without a target were left out", spec.name, lost)
    grown = (classifier or forest()).fit(dealt(train_rows, parts))
    model = RiskModel(spec, PipelineModel(stages=[*fitted.stages, grown]), n_train, parts)
    predictions = stage(model.predict(test_rows.drop(IS_TRAIN, ROW_HASH)))
    scored = classification_metrics(confusion(predictions, LABEL)).first()
    return TrainResult(
        model,
        predictions,
        {name: scored[name] for name in METRICS},
        n_train,
        scored["n_rows"] or 0,
        lost,
    )


def dealt(rows: DataFrame, partitions: int) -> DataFrame:
    """Rows dealt and ordered by what they held before scaling, however they came.

    A forest draws its samples by partition and place, so this makes the model depend on the rows
    and the number of partitions, not on files, cores or executors; the scaler's sums, and so the
    last digits of thresholds, may still differ.
    """
    return rows.repartition(partitions, ROW_HASH).sortWithinPartitions(ROW_HASH, LABEL)


def evaluation_report(spark: SparkSession, results: Mapping[str, TrainResult]) -> DataFrame:
    """``(disease, accuracy, precision, recall, f1_score, train_rows, test_rows)``."""
    rows = [
        (name, *[r.metrics[m] for m in METRICS], r.train_rows, r.test_rows)
        for name, r in results.items()
    ]
    return spark.createDataFrame(
        rows,
        "disease string, accuracy double, precision double, recall double, f1_score double, "
        "train_rows long, test_rows long",
    )


def train_all(
    spark: SparkSession,
    specs: Mapping[str, DatasetSpec],
    clean_root: str,
    model_root: str,
    report_path: str | None = None,
    from_features: bool = False,
    at_once: int = AT_ONCE,
    evaluations: str | None = None,
    **options,
) -> dict[str, TrainResult]:
    """Train every dataset from ``<clean_root>/<name>`` and save to ``<model_root>/<name>``.

    ``from_features`` takes ``clean_root`` as what ``featurize_all`` wrote.  ``at_once`` datasets are
    trained side by side (see ``side_by_side``).  One that fails leaves the others: they are trained,
    saved and reported before its error is raised.  ``evaluations`` is a folder that keeps the
    confusion counts, for reports over later test rows as well (see ``evaluation_of_parts``).
    """

    def one(name: str, spec: DatasetSpec) -> TrainResult:
        rows = read_table(spark, f"{clean_root}/{name}")
        if from_features:
            fitted = PipelineModel.load(f"{clean_root}/{name}.stages")
            result = train_from_features(rows, spec, fitted, **options)
        else:
            result = train(rows, spec, **options)
        save_model(result.model, f"{model_root}/{name}")
        if evaluations:
            add_evaluation(result.predictions, evaluations, name, "trained", result.train_rows)
        return result

    tasks = {name: partial(one, name, spec) for name, spec in specs.items()}
    results, failures = side_by_side(spark, tasks, at_once)
    if report_path:
        write_report(evaluation_report(spark, results), report_path)
    if failures:
        raise ExceptionGroup(f"not trained: {', '.join(failures)}", list(failures.values()))
    return results


def side_by_side(
    spark: SparkSession, tasks: Mapping[str, Callable[[], T]], at_once: int = AT_ONCE
) -> tuple[dict[str, T], dict[str, Exception]]:
    """Results and errors of tasks that run in threads, ``at_once`` of them.

    A small dataset does not fill a cluster, nor does the last stage of a large one; others then use
    the free cores.  Each task's jobs go to a scheduler pool of its name, so that with
    ``spark.scheduler.mode=FAIR`` they share the cluster evenly; threads inherit the session and
    the caller's local properties.  Results keep the order of ``tasks``.
    """

    def run(name: str) -> T | Exception:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return tasks[name]()
        except Exception as error:  # noqa: BLE001, handed to the caller
            log.error("%s failed: %s", name, error)
            return error

    with ThreadPoolExecutor(max(1, at_once)) as threads:
        running = {name: threads.submit(inheritable_thread_target(spark)(run), name) for name in tasks}
        done = {name: future.result() for name, future in running.items()}
    failures = {name: r for name, r in done.items() if isinstance(r, Exception)}
    return {name: r for name, r in done.items() if name not in failures}, failures


def feature_columns(features: DataFrame, spec: DatasetSpec) -> DataFrame:
    """A feature table with one plain column per feature, for reading by other tools."""
    values = vector_to_array(features[FEATURES])
    return features.select(
        LABEL, *[values[i].alias(name) for i, name in enumerate(spec.features)]
    )
