"""Whole jobs: cleaning chain, feature tables, training."""

from riskpipe.plans.cleaning import (
    CleanResult,
    clean,
    clean_all,
    quality_report,
    stage_counts,
)
from riskpipe.plans.evaluation import add_evaluation, evaluation_of_parts, evaluation_parts
from riskpipe.plans.learning import (
    TrainResult,
    evaluation_report,
    feature_columns,
    featurize_all,
    train,
    train_all,
    train_from_features,
)

__all__ = [
    "add_evaluation",
    "evaluation_of_parts",
    "evaluation_parts",
    "CleanResult",
    "TrainResult",
    "clean",
    "clean_all",
    "evaluation_report",
    "feature_columns",
    "featurize_all",
    "quality_report",
    "stage_counts",
    "train",
    "train_all",
    "train_from_features",
]
