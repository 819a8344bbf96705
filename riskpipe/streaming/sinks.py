"""Sinks of micro-batches that are written once, also where a batch is run again.

A stream that fails between two sinks runs its last batch anew.  ``batch_table`` replaces what an
earlier run of a batch left, so running it again changes nothing.  ``once`` remembers finished
batches for any sink, so that one which cannot replace its output is not run again after it has
ended.  ``fan_out`` applies both to several sinks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

BatchSink = Callable[[DataFrame, int], None]
BATCH_ID = "batch_id"


def batch_table(path: str, file_format: str = "parquet") -> BatchSink:
    """A table below ``path`` with the batch's number as its partition, each batch replaced whole."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(file_format).save(f"{path}/{BATCH_ID}={batch_id}")

    return write


def _files(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def once(sink: BatchSink, folder: str) -> BatchSink:
    """``sink``, but for the batches that it has ended before: those have a file in ``folder``.

    A sink that fails halfway runs again; make it replace its output, as ``batch_table`` does.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        mark, files = _files(batch.sparkSession, f"{folder}/{batch_id}")
        if not files.exists(mark):
            sink(batch, batch_id)
            files.create(mark, True).close()

    return write


def fan_out(*sinks: BatchSink, progress: str | None = None) -> BatchSink:
    """One batch function for several sinks.

    Empty batches are skipped.  With more than one sink the batch is kept while they write, so it
    is scored once; what an executor loss takes of it is computed again.  With ``progress``, a
    folder of its own beside the stream's checkpoint, a batch that is run again goes only to the
    sinks that had not ended it; they are told apart by their place in the list.
    """
    if progress:
        sinks = tuple(once(sink, f"{progress}/{i}") for i, sink in enumerate(sinks))

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist() if len(sinks) > 1 else batch
        try:
            if not kept.isEmpty():
                for sink in sinks:
                    sink(kept, batch_id)
        finally:
            if len(sinks) > 1:
                kept.unpersist()

    return write


def print_rows(batch: DataFrame, batch_id: int) -> None:
    """Print all rows of a batch, one JSON line each; the driver holds one partition at a time."""
    print(f"batch {batch_id}")
    for row in batch.toJSON().toLocalIterator():
        print(row)
