"""Display formatting done with exact integer arithmetic (no float rounding).

Money is handled in integer cents; quotients use DECIMAL(38,0), so results
stay exact far beyond the 2^53 limit of doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_WIDE = "decimal(38,0)"


def int_div(a: Column, b: Column | int) -> Column:
    """Floor division of integers, exact (``a div b`` for a, b >= 0)."""
    b = b if isinstance(b, Column) else F.lit(b)
    return F.floor(a.cast(_WIDE) / b.cast(_WIDE)).cast(_WIDE)


def half_even_div(a: Column, b: Column) -> Column:
    """Round a / b to the nearest integer, ties to even, exactly (b > 0)."""
    mag = F.abs(a).cast(_WIDE)
    b = b.cast(_WIDE)
    q = int_div(mag, b)
    r2 = (mag - q * b) * 2
    rounded = (
        F.when(r2 > b, q + 1)
        .when((r2 == b) & (q % 2 == 1), q + 1)
        .otherwise(q)
    )
    return F.when(a < 0, -rounded).otherwise(rounded).cast(_WIDE)


def thousands(col: Column) -> Column:
    """Integer with thousands separators: 1234567 -> '1,234,567'."""
    return F.format_number(col.cast(_WIDE), 0)


def _parts(cents: Column) -> tuple[Column, Column, Column]:
    mag = F.abs(cents).cast(_WIDE)
    sign = F.when(cents < 0, F.lit("-")).otherwise(F.lit(""))
    frac = F.lpad((mag % 100).cast("string"), 2, "0")
    return sign, int_div(mag, 100), frac


def dollars(cents: Column) -> Column:
    """Cents as '$1,234.56' (sign after the mark, as Python's format does)."""
    sign, whole, frac = _parts(cents)
    return F.concat(F.lit("$"), sign, thousands(whole), F.lit("."), frac)


def plain_dollars(cents: Column) -> Column:
    """Cents as '$1234.56': no thousands separator."""
    sign, whole, frac = _parts(cents)
    return F.concat(F.lit("$"), sign, whole.cast("string"), F.lit("."), frac)
