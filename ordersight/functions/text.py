"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def single_line(col: Column) -> Column:
    """Line breaks become a comma and a blank, as addresses are written on one line."""
    return F.replace(col, F.lit("\n"), F.lit(", "))
