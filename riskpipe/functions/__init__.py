"""Column-level building blocks: every function returns a ``Column``."""

from riskpipe.functions.columns import as_double, col, literal, present, quoted
from riskpipe.functions.missing import is_missing, missing_cells
from riskpipe.functions.risk import (
    class_probability,
    missing_fields,
    risk_band,
    risk_from_label,
)

__all__ = [
    "as_double",
    "class_probability",
    "col",
    "is_missing",
    "literal",
    "missing_cells",
    "missing_fields",
    "present",
    "quoted",
    "risk_band",
    "risk_from_label",
]
