"""Date helpers: literals computed once on the driver (constant folding), and
calendar rules used by the workloads."""

from __future__ import annotations

import calendar
import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def _parse(s: str) -> _dt.date:
    return _dt.date.fromisoformat(s[:10])


def add_months_str(s: str, months: int) -> str:
    d = _parse(s)
    m = d.month - 1 + months
    y = d.year + m // 12
    m = m % 12 + 1
    day = min(d.day, calendar.monthrange(y, m)[1])
    return _dt.date(y, m, day).isoformat()


def ts_lit(s: str) -> Column:
    """TIMESTAMP_NTZ literal, the type the fixtures' date columns have, so the
    comparison is pushed into the Parquet scan without casting the column."""
    return F.expr(f"TIMESTAMP_NTZ '{s}'")


def date_from_yymm(yymm: Column, pivot: int = 80) -> Column:
    """'9104' -> 1991-04-01; two-digit years above ``pivot`` are 19xx."""
    yy = F.substring(yymm, 1, 2).cast("int")
    mm = F.substring(yymm, 3, 2).cast("int")
    year = F.when(yy > pivot, F.lit(1900) + yy).otherwise(F.lit(2000) + yy)
    return F.make_date(year, mm, F.lit(1))
