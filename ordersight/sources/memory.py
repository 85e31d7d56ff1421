"""In-memory sources for small literal inputs (tests, parameters)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ordersight.schema import ORDERS_SCHEMA


def from_rows(spark: SparkSession, rows: Iterable[Sequence], columns: Sequence[str] | None = None) -> DataFrame:
    """A DataFrame from literal tuples; ``columns`` names them in order."""
    return spark.createDataFrame(list(rows), list(columns) if columns else None)


def orders_from_rows(spark: SparkSession, rows: Iterable[Sequence]) -> DataFrame:
    """Literal order rows in the declared 25-column schema."""
    return spark.createDataFrame(list(rows), ORDERS_SCHEMA)
