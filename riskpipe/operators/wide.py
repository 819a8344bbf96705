"""An indexer for categories whose labels are too many to be carried to every task.

``StringIndexer`` keeps its labels in the model, on the driver and in every task.  ``TableIndexer``
keeps them as a Parquet table instead, ``(column_name, value, n_rows, label_index)``, which lies
beside the saved stage, and joins it: when fitted, when a table is scored and in every batch of a
stream.  Indices are the same: most frequent value first, ties by value, null and unseen values
behind the last.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskpipe.functions.columns import col
from riskpipe.operators.profile import label_dictionary
from riskpipe.sources.staging import stage

HOT_SHARE = 1e-6  # values with more of the rows than this are broadcast: a million at most
SALTS = 10_000

DICTIONARY_SCHEMA = "column_name string, value string, n_rows long, label_index long"


def join_index(
    df: DataFrame,
    name: str,
    index: str,
    known: DataFrame,
    size: int,
    total: int,
    hot_share: float = HOT_SHARE,
) -> DataFrame:
    """Add ``index`` to ``df`` by joining the dictionary ``known`` of its column ``name``.

    ``size`` is the number of the dictionary's values and ``total`` the rows they were counted in.
    The values that hold more than ``hot_share`` of those are broadcast, at most ``1 / hot_share``
    of them.  Only the remaining rows take part in a shuffled join, so none of its keys had a
    larger share; the settled rows are spread over it by salts that match nothing.
    """
    hot = F.col("n_rows") > F.lit(hot_share) * F.lit(total)
    known = known.select(
        hot.alias("__hot"),
        F.col("value").alias("__value"),
        F.col("label_index").cast("double").alias("__index"),
    )
    value = col(name).cast("string")
    first = F.broadcast(known.filter("__hot").drop("__hot"))
    joined = df.join(first, value == F.col("__value"), "left").drop("__value")
    salt = F.pmod(F.xxhash64(*[col(c) for c in df.columns]), F.lit(SALTS)) + 1
    open_row = F.col("__index").isNull() & col(name).isNotNull()
    joined = joined.withColumn("__salt", F.when(open_row, F.lit(0).cast("long")).otherwise(salt))
    rest = known.filter("NOT __hot").select(
        F.col("__value"), F.lit(0).cast("long").alias("__no_salt"), F.col("__index").alias("__late")
    )
    found = joined.join(
        rest, (value == F.col("__value")) & (F.col("__salt") == F.col("__no_salt")), "left"
    )
    return found.withColumn(
        index, F.coalesce(F.col("__index"), F.col("__late"), F.lit(float(size)))
    ).drop("__index", "__late", "__value", "__salt", "__no_salt")


class _Columns(HasInputCols, HasOutputCols):
    hotShare = Param(
        Params._dummy(),
        "hotShare",
        "share of the fitted rows above which a value is broadcast",
        TypeConverters.toFloat,
    )

    def __init__(self) -> None:
        super().__init__()
        self._setDefault(hotShare=HOT_SHARE)


class TableIndexer(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Fit the dictionaries of all input columns in one counting job."""

    def __init__(
        self,
        inputCols: Sequence[str] = (),
        outputCols: Sequence[str] = (),
        hotShare: float = HOT_SHARE,
    ) -> None:
        super().__init__()
        self._set(inputCols=list(inputCols), outputCols=list(outputCols), hotShare=hotShare)

    def _fit(self, dataset: DataFrame) -> TableIndexerModel:
        names = self.getInputCols()
        known = label_dictionary(dataset, names)
        counted = {
            row["column_name"]: row
            for row in known.groupBy("column_name")
            .agg(F.count("*").alias("size"), F.sum("n_rows").alias("total"))
            .collect()  # a row per column
        }
        sizes = [counted[name]["size"] if name in counted else 0 for name in names]
        totals = [counted[name]["total"] if name in counted else 0 for name in names]
        model = TableIndexerModel(stage(known))
        self._copyValues(model)
        return model._set(sizes=sizes, totals=totals)


class TableIndexerModel(Model, _Columns, MLReadable, MLWritable):
    """Fitted dictionaries. ``dictionary`` is a table that outlives the model's use."""

    sizes = Param(Params._dummy(), "sizes", "values of each column", TypeConverters.toListInt)
    totals = Param(
        Params._dummy(), "totals", "rows that each column was counted in", TypeConverters.toListInt
    )

    def __init__(self, dictionary: DataFrame | None = None) -> None:
        super().__init__()
        self.dictionary = dictionary

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fitted = zip(
            self._fitted_columns(), self.getInputCols(), self.getOutputCols(),
            self.getOrDefault(self.sizes), self.getOrDefault(self.totals), strict=True,
        )
        for key, name, index, size, total in fitted:
            known = self.dictionary.filter(F.col("column_name") == key)
            hot_share = self.getOrDefault(self.hotShare)
            dataset = join_index(dataset, name, index, known, size, total, hot_share)
        return dataset

    fittedCols = Param(
        Params._dummy(),
        "fittedCols",
        "names that the dictionary knows the input columns by",
        TypeConverters.toListString,
    )

    def _fitted_columns(self) -> list[str]:
        return self.getOrDefault(self.fittedCols if self.isSet(self.fittedCols) else self.inputCols)

    def renamed(self, prefix: str) -> TableIndexerModel:
        """A copy that reads and writes prefixed columns."""
        names = self._fitted_columns()
        return self.copy(
            {
                self.fittedCols: names,
                self.inputCols: [prefix + name for name in self.getInputCols()],
                self.outputCols: [prefix + name for name in self.getOutputCols()],
            }
        )

    def detached(self) -> TableIndexerModel:
        """A copy whose dictionary is a table of its own, so that the first one's may go."""
        other = self.copy()
        other.dictionary = stage(self.dictionary)
        return other

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, model: TableIndexerModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, SparkSession.builder.getOrCreate())
        self.model.dictionary.write.parquet(f"{path}/dictionary")


class _Reader(MLReader):
    def load(self, path: str) -> TableIndexerModel:
        spark = SparkSession.builder.getOrCreate()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = TableIndexerModel(
            spark.read.schema(DICTIONARY_SCHEMA).parquet(f"{path}/dictionary")
        )
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
