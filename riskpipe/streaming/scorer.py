"""Scoring a stream of records.

Scoring keeps no state, so a stream is scored by the same plan as a table and its only state is
the source's progress, kept in the checkpoint.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from riskpipe.operators.scoring import score
from riskpipe.operators.training import RiskModel, load_model
from riskpipe.sources.tables import read_stream
from riskpipe.spec import RECORD_KEYS, RECORD_SCHEMA, DatasetSpec
from riskpipe.streaming.quarantine import CORRUPT, with_quarantine
from riskpipe.streaming.sinks import BatchSink, batch_table, once, print_rows


def load_models(root: str, specs: Mapping[str, DatasetSpec]) -> dict[str, RiskModel]:
    """The fitted pipelines below ``root``; nothing is fitted again for scoring."""
    return {name: load_model(f"{root}/{name}", spec) for name, spec in specs.items()}


def _timed(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def write_stream(
    results: DataFrame,
    checkpoint: str,
    sink: str | BatchSink = "parquet",
    path: str | None = None,
    every: str | None = "5 seconds",
    name: str | None = None,
) -> StreamingQuery:
    """Start writing a streaming frame.

    ``sink`` is a format (``parquet`` and ``json``, which need a ``path``, or ``memory``),
    ``console``, which prints every row, or a function of a batch and its number, such as
    ``fan_out(...)``.  ``every=None`` processes what is there and stops.  The row count of each
    batch is in the query's ``lastProgress``.
    """
    if sink in ("parquet", "json") and not path:
        raise ValueError(f"a {sink} sink needs a path")
    sink = print_rows if sink == "console" else sink
    writer = results.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    if callable(sink):
        return _timed(writer.foreachBatch(sink), every).start()
    writer = _timed(writer.format(sink), every)
    return writer.start(path) if path else writer.start()


def start_scoring(
    spark: SparkSession,
    input_path: str,
    models: Mapping[str, RiskModel],
    checkpoint: str,
    sink: str | BatchSink = "parquet",
    output_path: str | None = None,
    every: str | None = "5 seconds",
    max_files_per_trigger: int | None = 1,
    missing: str = "error",
    quarantine_path: str | None = None,
) -> StreamingQuery:
    """Watch a folder of JSON records and write their risk profiles.

    A record that does not parse is scored as one without measurements.  With ``quarantine_path``
    it is not: it goes there, to a table ``(batch_id, file, reason, record)``.  Both tables then
    have the batch's number as a partition, and a batch that is run again replaces its own rows.
    """
    if not quarantine_path:
        records = read_stream(spark, input_path, RECORD_SCHEMA, max_files_per_trigger)
        results = score(records, models, RECORD_KEYS, missing)
        return write_stream(results, checkpoint, sink, output_path, every)
    records = read_stream(spark, input_path, RECORD_SCHEMA, max_files_per_trigger, CORRUPT)
    if sink == "console":
        sink = print_rows
    elif not callable(sink):
        sink = batch_table(output_path, sink)
    write = with_quarantine(
        lambda sound: score(sound, models, RECORD_KEYS, missing),
        once(sink, f"{checkpoint}/sinks/scores"),
        batch_table(quarantine_path),
    )
    return write_stream(records, checkpoint, write, every=every)
