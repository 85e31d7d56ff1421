"""Date buckets. Aggregate on the DATE value, format only the grouped rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(col: Column) -> Column:
    return F.trunc(col, "month")


def month_label(col: Column) -> Column:
    return F.date_format(col, "yyyy-MM")
