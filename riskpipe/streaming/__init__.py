"""Structured Streaming: scoring records as they arrive."""

from riskpipe.streaming.quarantine import broken_records, sound_records, with_quarantine
from riskpipe.streaming.scorer import load_models, start_scoring, write_stream
from riskpipe.streaming.sinks import batch_table, fan_out, once, print_rows

__all__ = [
    "batch_table",
    "broken_records",
    "fan_out",
    "load_models",
    "once",
    "print_rows",
    "sound_records",
    "start_scoring",
    "with_quarantine",
    "write_stream",
]
