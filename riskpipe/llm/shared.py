"""What the operators of this subpackage share: input columns, Arrow batches, checkpoints."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DataType, StructField, StructType

#: Words of a text: runs of anything but ASCII blanks. ``bytes.split()`` cuts at the same six bytes.
WORD = r"[^\x20\x09-\x0D]+"
#: Rows that leave Python at once, so that no task holds the results of a whole input batch.
SLICE_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text``, a null text as the empty one."""
    return df.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share, as the session's ``spark.checkpoint.dir`` names it.

    Only where that is unset, as in local tests, a temporary folder takes its place.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root and not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="riskpipe-llm-"))
    return context._jsc.sc().getCheckpointDir().get()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder; the files go when nothing refers to the frame any more.

    Spark's cleaner deletes them then, if it is told to by a setting that it reads for each checkpoint.
    """
    shared_folder(df.sparkSession)
    df.sparkSession._jsc.sc().conf().set("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffles and checkpoints of frames that are gone by now.

    It learns of them from the driver's garbage collection, which may not come for a long time. The JVM
    is told first which frames Python has let go; by itself py4j tells it up to a second later. Spark's
    listeners hold the plan of the query that ended last, so a query of a constant follows.
    """
    gc.collect()
    gone = getattr(spark.sparkContext._gateway._gateway_client, "finalizer_deque", None)
    while gone:
        try:
            task = gone.pop()
        except IndexError:  # py4j's own thread has told of it
            break
        if not isinstance(task, tuple):  # that thread is to end
            gone.append(task)
            break
        client, frame = task
        client.garbage_collect_object(frame, False)
    spark.sql("SELECT 1").collect()
    spark._jvm.System.gc()


def about(df: DataFrame, most: int, *key: str) -> DataFrame:
    """About ``most`` rows of ``df``, by a hash of their ``key``; all of them if there are no more.

    The rows are counted first, so that the sample is as large wherever it lies; a limit would
    take its rows from every partition. ``key`` should tell rows apart.
    """
    n = df.count()
    if n <= most:
        return df
    return df.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 32)) < F.lit(most * (1 << 32) // n))


@contextmanager
def workspace(spark: SparkSession) -> Iterator[str]:
    """A new path in the shared folder for tables that nothing needs afterwards."""
    path = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def slices(source: Iterator[pa.RecordBatch]) -> Iterator[list[list]]:
    """The columns of batches as Python lists, ``SLICE_ROWS`` rows at a time.

    A batch may hold thousands of texts; as Python strings they take several times its memory.
    """
    for batch in source:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            yield [column.to_pylist() for column in batch.slice(start, SLICE_ROWS).columns]


def map_columns(
    df: DataFrame, function: Callable[..., list[tuple]], keep: str, more: str
) -> DataFrame:
    """Rows made by ``function`` from the Python lists of ``df``'s columns, slice by slice.

    The result has ``df``'s column ``keep``, as it is, and the columns of the DDL string ``more``.
    """
    kept: DataType = df.schema[keep].dataType
    schema = StructType([StructField(keep, kept), *StructType.fromDDL(more)])
    target = to_arrow_schema(schema)

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows = function(*(column.to_pylist() for column in part.columns))
                columns = list(zip(*rows, strict=True)) or [()] * len(target)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(columns, target, strict=True)],
                    schema=target,
                )

    return df.mapInArrow(batches, schema)

