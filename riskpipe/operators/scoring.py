"""Scoring patient records against several models at once.

All models run side by side over one pass of the records: each takes its inputs from columns that
carry its own prefix, and the results are unfolded into one row per record and dataset at the end.
Nothing here is an action, so batch and streaming frames take the same path.  It shuffles only
where a category is so wide that its dictionary is a table, which is joined.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Transformer
from pyspark.ml.feature import StringIndexerModel, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskpipe.functions.columns import col, literal, quoted
from riskpipe.functions.risk import missing_fields, risk_band, risk_from_label
from riskpipe.operators.features import RAW
from riskpipe.operators.training import RiskModel
from riskpipe.operators.wide import TableIndexerModel
from riskpipe.spec import RECORD_KEYS, DatasetSpec

MISSING_MODES = ("error", "zero")
INDEXERS = (StringIndexerModel, TableIndexerModel)


def record_inputs(
    records: DataFrame, spec: DatasetSpec, missing: str = "error"
) -> dict[str, str]:
    """SQL text of the spec's input columns, read from the record fields that feed them.

    A field the records do not have reads as null.  With ``missing="zero"`` null numbers score as
    zero; a null text always scores as an unseen category.
    """
    if missing not in MISSING_MODES:
        raise ValueError(f"missing must be one of {MISSING_MODES}")
    have = set(records.columns)
    inputs = {}
    for name in spec.inputs:
        source = spec.record_field(name)
        cell = quoted(source) if source in have else "CAST(NULL AS STRING)"
        if name in spec.numeric:
            cell = f"try_cast({cell} AS DOUBLE)"
            if missing == "zero":
                cell = f"coalesce({cell}, 0D)"
        inputs[name] = cell
    return inputs


def _error(spec: DatasetSpec, inputs: Mapping[str, str]) -> Column:
    return missing_fields({spec.record_field(n): inputs[n] for n in spec.numeric})


def project_for(
    records: DataFrame,
    spec: DatasetSpec,
    keep: Sequence[str] = RECORD_KEYS,
    missing: str = "error",
) -> DataFrame:
    """Records renamed to the spec's training columns, with the ``keep`` columns in front."""
    inputs = record_inputs(records, spec, missing)
    return records.selectExpr(
        *[quoted(name) for name in keep],
        *[f"{cell} AS {quoted(name)}" for name, cell in inputs.items()],
    )


def score_errors(
    records: DataFrame,
    spec: DatasetSpec,
    keep: Sequence[str] = RECORD_KEYS,
    missing: str = "error",
) -> DataFrame:
    """``keep`` columns and ``error``: which inputs, if any, prevent a score."""
    error = _error(spec, record_inputs(records, spec, missing))
    return records.select(*[col(name) for name in keep], error.alias("error"))


def _bound(stage: Transformer, prefix: str) -> Transformer:
    """A copy of a fitted stage that reads and writes prefixed columns."""
    if isinstance(stage, TableIndexerModel):
        return stage.renamed(prefix)
    renamed = {}
    for param in stage.params:
        if not param.name.endswith(("Col", "Cols")) or not stage.isDefined(param):
            continue
        if stage.hasParam(f"{param.name}s") and stage.isDefined(stage.getParam(f"{param.name}s")):
            continue  # the default of the one-column form, not in use
        value = stage.getOrDefault(param)
        if isinstance(value, list):
            renamed[param] = [prefix + name for name in value]
        elif value:
            renamed[param] = prefix + value
    return stage.copy(renamed)


def _is_target_indexer(stage: Transformer, spec: DatasetSpec) -> bool:
    return isinstance(stage, StringIndexerModel) and (
        stage.isSet(stage.inputCol) and stage.getInputCol() == spec.target
    )


def _score_wide(
    records: DataFrame, models: Mapping[str, RiskModel], keep: Sequence[str], missing: str
) -> tuple[DataFrame, dict[str, Column]]:
    """The records with every model's output beside them, and a result struct per dataset.

    A dataset's numbers travel as one array column.  With a column each, a filter on a result
    would make the optimizer derive constraints for every subset of the renamed columns.
    """
    prefixes = {name: f"m{i}__" for i, name in enumerate(models)}
    wide = [quoted(name) for name in keep]
    for name, model in models.items():
        inputs = record_inputs(records, model.spec, missing)
        numbers = ", ".join(f"coalesce({inputs[n]}, double('NaN'))" for n in model.spec.numeric)
        wide.append(f"CAST(array({numbers}) AS ARRAY<DOUBLE>) AS {prefixes[name]}numbers")
        wide += [
            f"{inputs[n]} AS {quoted(prefixes[name] + n)}" for n in model.spec.categorical
        ]
    scored = records.selectExpr(*wide)

    for name, model in models.items():
        prefix = prefixes[name]
        stages = [s for s in model.pipeline.stages if not _is_target_indexer(s, model.spec)]
        before = [s for s in stages if isinstance(s, INDEXERS)]
        after = [s for s in stages if not isinstance(s, (*INDEXERS, VectorAssembler))]
        for fitted in before:
            scored = _bound(fitted, prefix).transform(scored)
        indices = F.array(*[col(prefix + n) for n in model.spec.indexed]).cast("array<double>")
        features = array_to_vector(F.concat(F.col(f"{prefix}numbers"), indices))
        scored = scored.withColumns(
            {prefix + RAW: features, f"{prefix}error": _array_error(model.spec, prefix)}
        )
        for fitted in after:
            scored = _bound(fitted, prefix).transform(scored)
        classes = vector_to_array(col(prefix + model.forest.getProbabilityCol()))
        scored = scored.withColumn(f"{prefix}classes", classes)
    return scored, {name: _result(name, models[name], prefixes[name]) for name in models}


def _array_error(spec: DatasetSpec, prefix: str) -> Column:
    """``missing_fields`` over the array of a dataset's numbers."""
    names = ", ".join(literal(spec.record_field(n)) for n in spec.numeric)
    lacking = f"transform({prefix}numbers, (x, i) -> IF(isnan(x), array({names})[i], NULL))"
    return F.expr(f"'missing: ' || nullif(array_join({lacking}, ', '), '')")


def _result(name: str, model: RiskModel, prefix: str) -> Column:
    error = col(f"{prefix}error")
    classes = F.col(f"{prefix}classes")
    labels = model.labels
    if labels is None:
        risk = risk_band(F.get(classes, F.lit(1)))
    else:
        risk = risk_from_label(col(prefix + model.forest.getPredictionCol()), labels)
    return F.struct(
        F.lit(name).alias("dataset"),
        F.when(error.isNull(), risk).alias("risk"),
        F.when(error.isNull(), classes).alias("probability"),
        error.alias("error"),
    )


def score(
    records: DataFrame,
    models: Mapping[str, RiskModel],
    keep: Sequence[str] = RECORD_KEYS,
    missing: str = "error",
) -> DataFrame:
    """``keep`` columns, ``dataset``, ``risk``, ``probability``, ``error``: a row per model.

    Two-class models are banded by the probability of class 1, models with named classes by the
    name of the predicted class.  A record that lacks an input has an error and no risk for that
    dataset, and its scores for the other datasets.
    """
    scored, results = _score_wide(records, models, keep, missing)
    return scored.select(*[col(name) for name in keep], F.inline(F.array(*results.values())))


def risk_profile(
    records: DataFrame,
    models: Mapping[str, RiskModel],
    keep: Sequence[str] = RECORD_KEYS,
    missing: str = "error",
    pivot: bool = False,
) -> DataFrame:
    """All results of each record: as rows (see ``score``), or pivoted to one struct a dataset."""
    if not pivot:
        return score(records, models, keep, missing)
    scored, results = _score_wide(records, models, keep, missing)
    return scored.select(
        *[col(name) for name in keep],
        *[result.dropFields("dataset").alias(name) for name, result in results.items()],
    )
