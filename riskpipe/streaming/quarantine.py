"""Records that do not parse: told apart, explained and kept.

Read with a column for them, such a record reaches the stream as its text.  It is no patient without
measurements, so it is not scored; it goes to a table of its own, with its file and the reason.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructType

from riskpipe.functions.columns import literal
from riskpipe.spec import RECORD_SCHEMA
from riskpipe.streaming.sinks import BatchSink

CORRUPT = "_corrupt_record"
NOT_JSON, NOT_OBJECT, WRONG_TYPE = "not JSON", "not a JSON object", "no number: "

#: What JSON readers take for a number, as variants name it.
_NUMBERS = "'^(BIGINT|DOUBLE|FLOAT|DECIMAL.*|VOID)$'"


def reason(value: str, schema: StructType = RECORD_SCHEMA) -> Column:
    """Why a record did not parse: no JSON, no object, or the fields that should be numbers.

    ``value`` is a column of variants, as it is read once for every field.
    """
    names = [f.name for f in schema if isinstance(f.dataType, DoubleType)]
    odd = ", ".join(
        f"IF(schema_of_variant(try_variant_get({value}, {literal('$.' + name)}, 'variant')) "
        f"RLIKE {_NUMBERS}, NULL, "
        f"nvl2(try_variant_get({value}, {literal('$.' + name)}, 'variant'), {literal(name)}, NULL))"
        for name in names
    )
    return F.expr(
        f"CASE WHEN {value} IS NULL THEN {literal(NOT_JSON)} "
        f"WHEN schema_of_variant({value}) NOT LIKE 'OBJECT%' THEN {literal(NOT_OBJECT)} "
        f"ELSE {literal(WRONG_TYPE)} || array_join(array({odd}), ', ') END"
    )


def broken_records(records: DataFrame, schema: StructType = RECORD_SCHEMA) -> DataFrame:
    """``file, reason, record`` of the records that did not parse."""
    return (
        records.filter(F.col(CORRUPT).isNotNull())
        .select("file", F.col(CORRUPT).alias("record"), F.expr(f"try_parse_json({CORRUPT})").alias("value"))
        .select("file", reason("value", schema).alias("reason"), "record")
    )


def sound_records(records: DataFrame) -> DataFrame:
    """The records that did parse, as they would come without a column for the others."""
    return records.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "file")


def with_quarantine(
    transform: Callable[[DataFrame], DataFrame], sink: BatchSink, quarantine: BatchSink
) -> BatchSink:
    """A batch function that hands sound records through ``transform`` to ``sink``.

    The others go to ``quarantine`` as ``broken_records``; a batch without any writes nothing there.
    The batch is kept meanwhile, so its files are read once, and also because a file's rows may not
    be asked for their broken records alone.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            sink(transform(sound_records(kept)), batch_id)
            broken = broken_records(kept)
            if not broken.isEmpty():
                quarantine(broken, batch_id)
        finally:
            kept.unpersist()

    return write
