"""Exact money arithmetic.

Floating-point sums depend on the order rows arrive in, which differs between
runs and engines. Inputs with two decimals are cast to DECIMAL, summed exactly
(the TPC-H strict schema), and the result is cast back to double once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- units
# Money in integer units (cents, or 1e-4 after multiplying by a rate in
# percent) summed as two 64-bit halves: both partial sums stay compact longs
# in the aggregation buffer (a DECIMAL(28+) buffer is stored as variable-
# length bytes and is several times slower). With |x| < 2^40 per row the
# halves cannot overflow below 2^43 rows per group. The halves are combined
# once per group as DECIMAL(38,0).
SPLIT_BITS = 20


def units(c, scale: int = 2) -> Column:
    """c * 10^scale as bigint, for values with ``scale`` decimals: the
    product lies within rounding noise of an integer, so ``rint`` (plain
    Math.rint, unlike ``round`` which goes through BigDecimal per row) is exact."""
    return F.rint(_c(c) * float(10 ** scale)).cast("bigint")


def units_sum(x: Column, bits: int = SPLIT_BITS) -> Column:
    """Exact sum of a bigint expression as DECIMAL(38,0)."""
    hi = F.sum(F.shiftright(x, bits)).cast("decimal(38,0)")
    lo = F.sum(x.bitwiseAND(F.lit((1 << bits) - 1))).cast("decimal(38,0)")
    return hi * F.lit(1 << bits).cast("decimal(38,0)") + lo


def units_to_double(total: Column, scale: int) -> Column:
    return total.cast("double") / float(10 ** scale)


def money_sum(x: Column, scale: int) -> Column:
    """Exact sum of integer units of 10^-scale, as double."""
    return units_to_double(units_sum(x), scale)


def round_units(total: Column, from_scale: int, to_scale: int) -> Column:
    """Round an exact unit total half away from zero to ``to_scale`` decimals
    and return it as double (SQL ``round`` on a decimal)."""
    d = 10 ** (from_scale - to_scale)
    mag = F.floor((F.abs(total) + F.lit(d // 2).cast("decimal(38,0)")) / F.lit(d).cast("decimal(38,0)"))
    return (F.signum(total.cast("double")) * mag.cast("double")) / float(10 ** to_scale)
