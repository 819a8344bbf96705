"""DataFrame operators: each takes a frame and returns a frame, a small result or a fitted model."""

from riskpipe.operators.features import (
    assembler,
    category_indexer,
    feature_stages,
    featurize,
    fit_features,
    index_by_join,
    label_indexer,
    scaler,
    target_labels,
    with_label,
)
from riskpipe.operators.metrics import classification_metrics, confusion
from riskpipe.operators.profile import (
    column_stats,
    continuous_columns,
    distinct_counts,
    label_dictionary,
    modes,
    value_counts,
)
from riskpipe.operators.quality import (
    drop_duplicate_rows,
    drop_ids,
    drop_sparse_rows,
    fill_missing,
    impute_median,
    impute_mode,
    medians,
    mode_values,
    outlier_bounds,
    remove_outliers,
    to_double,
    validate_schema,
)
from riskpipe.operators.quantiles import quantile_table, quantiles
from riskpipe.operators.scoring import project_for, risk_profile, score, score_errors
from riskpipe.operators.training import (
    RiskModel,
    forest,
    load_model,
    save_model,
    split,
    top_features,
    train_flag,
)
from riskpipe.operators.wide import TableIndexer, TableIndexerModel, join_index

__all__ = [
    "RiskModel",
    "TableIndexer",
    "TableIndexerModel",
    "assembler",
    "category_indexer",
    "classification_metrics",
    "column_stats",
    "confusion",
    "continuous_columns",
    "distinct_counts",
    "drop_duplicate_rows",
    "drop_ids",
    "drop_sparse_rows",
    "feature_stages",
    "featurize",
    "fill_missing",
    "fit_features",
    "forest",
    "impute_median",
    "impute_mode",
    "index_by_join",
    "join_index",
    "label_dictionary",
    "label_indexer",
    "load_model",
    "medians",
    "mode_values",
    "modes",
    "outlier_bounds",
    "project_for",
    "quantile_table",
    "quantiles",
    "remove_outliers",
    "risk_profile",
    "save_model",
    "scaler",
    "score",
    "score_errors",
    "split",
    "target_labels",
    "to_double",
    "top_features",
    "train_flag",
    "validate_schema",
    "value_counts",
    "with_label",
]
