"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from sparklab.functions.dates import ts_lit, add_months_str, date_from_yymm
from sparklab.functions.text import safe_int, strip_to_double

__all__ = [
    "ts_lit", "add_months_str", "date_from_yymm",
    "safe_int", "strip_to_double",
]
