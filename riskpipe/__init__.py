"""Tabular risk pipelines on Spark: clean, featurize, train, score."""

from riskpipe.spec import SPECS, DatasetSpec

__all__ = ["SPECS", "DatasetSpec"]
