"""String-to-number helpers for dirty inputs (ANSI mode: use try_cast)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_int(c, default: int = -1) -> Column:
    """int(float(x)) or ``default``: '12.0' -> 12, 'abc' -> default."""
    c = F.col(c) if isinstance(c, str) else c
    return F.coalesce(c.cast("string").try_cast("double").try_cast("int"), F.lit(default))


def strip_to_double(c, strip: str = "#") -> Column:
    """Remove ``strip`` characters, empty -> NULL, then try_cast to double."""
    c = F.col(c) if isinstance(c, str) else c
    cleaned = F.regexp_replace(c, "[" + "".join("\\" + ch for ch in strip) + "]", "")
    return F.nullif(F.trim(cleaned), F.lit("")).try_cast("double")
