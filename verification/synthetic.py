"""Synthetic patient records in bulk.

Every field is a hash of ``seed:field:id`` mapped into the field's domain, so a record depends on
nothing but its id: any partitioning, any retry and any other engine with md5 gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskpipe.functions.columns import quoted
from riskpipe.spec import RECORD_FIELDS, RecordField

FIRST_NAMES = ("Ada", "Bo", "Cleo", "Dara", "Eli", "Finn", "Gia", "Hugo", "Ines", "Jun")
LAST_NAMES = ("Abel", "Brook", "Cruz", "Dahl", "Egan", "Frost", "Gale", "Hart")
START = "2024-01-01 00:00:00"
SECONDS_APART = 5
SLOTS = 6_307_200  # five-second steps in a 365-day year; later ids start the year again

DRAWS = "draws"
DRAWN_FIELDS = ("first", "last", *[f.name for f in RECORD_FIELDS])


def _draw(field: str, low: int, high: int) -> str:
    """SQL for a whole number in ``low..high``."""
    return f"({low} + {DRAWS}[{DRAWN_FIELDS.index(field)}] % {high - low + 1})"


def _pick(field: str, choices: tuple[str, ...]) -> str:
    listed = ", ".join(f"'{c}'" for c in choices)
    return f"element_at(array({listed}), CAST({_draw(field, 1, len(choices))} AS INT))"


def _value(field: RecordField) -> str:
    if field.choices:
        return _pick(field.name, field.choices)
    drawn = f"CAST({_draw(field.name, field.low, field.high)} AS DOUBLE)"
    return f"{drawn} / {field.scale}" if field.scale > 1 else drawn


def synthesize_patients(
    source: DataFrame | SparkSession,
    n: int | None = None,
    seed: int = 42,
    id_column: str = "id",
) -> DataFrame:
    """One patient record per id.

    ``source`` is a session, for the ids ``0..n-1``, or a frame with a whole-number ``id_column``.
    """
    ids = source.range(n) if isinstance(source, SparkSession) else source
    number = quoted(id_column)
    # All hashes in one array: written out per field they make a method too long to be compiled.
    names = ", ".join(f"'{seed}:{name}:'" for name in DRAWN_FIELDS)
    digest = f"substr(md5(concat(f, CAST({number} AS STRING))), 1, 8)"
    hashes = f"transform(array({names}), f -> CAST(conv({digest}, 16, 10) AS BIGINT))"
    first, last = _pick("first", FIRST_NAMES), _pick("last", LAST_NAMES)
    # A timestamp without zone, so the text does not move with the session's zone.
    seconds = f"CAST({number} % {SLOTS} * {SECONDS_APART} AS INT)"
    return ids.selectExpr(quoted(id_column), f"{hashes} AS {DRAWS}").selectExpr(
        # the id itself ends the key: no two records share it
        f"concat_ws('-', 'PAT', {first}, {last}, {number}) AS patient_id",
        f"CAST(timestampadd(SECOND, {seconds}, TIMESTAMP_NTZ'{START}') AS STRING) AS timestamp",
        *[f"{_value(f)} AS {quoted(f.name)}" for f in RECORD_FIELDS],
    )
