"""Row-level views: first rows, column projection, table view, schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ordersight.operators.ordering import ordered_limit

DEFAULT_TABLE_COLUMNS = 10


def default_columns(df: DataFrame) -> list[str]:
    """The first 10 columns when there are more than 10, else all."""
    cols = list(df.columns)
    return cols[:DEFAULT_TABLE_COLUMNS] if len(cols) > DEFAULT_TABLE_COLUMNS else cols


def project_columns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    cols = default_columns(df) if columns is None else list(columns)
    if not cols:
        raise ValueError("no columns selected")
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.select(*cols)


def first_rows(df: DataFrame, n: int = 100, key: str = "order_id") -> DataFrame:
    return ordered_limit(df, n, key)


def table_view(df: DataFrame, columns: Sequence[str] | None = None, n: int | None = None) -> DataFrame:
    """Rows to display: limit first (in ``order_id`` order), then project."""
    return project_columns(ordered_limit(df, n), columns)


def schema_frame(df: DataFrame) -> DataFrame:
    """The schema as data: ordinal, column name, type and nullability."""
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(
        rows, "ordinal int, column_name string, data_type string, nullable boolean"
    )


def is_empty(df: DataFrame) -> bool:
    """Cheap emptiness test for callers (runs a limit-1 job)."""
    return df.isEmpty()


__all__ = ["default_columns", "project_columns", "first_rows", "table_view", "schema_frame", "is_empty"]
