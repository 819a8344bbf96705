"""Readers, writers and intermediate tables."""

from riskpipe.sources.staging import stage, staging, staging_dir
from riskpipe.sources.tables import (
    csv_schema,
    read_raw,
    read_stream,
    read_table,
    write_report,
    write_table,
)

__all__ = [
    "csv_schema",
    "read_raw",
    "read_stream",
    "read_table",
    "stage",
    "staging",
    "staging_dir",
    "write_report",
    "write_table",
]
