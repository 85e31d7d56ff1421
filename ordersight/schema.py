"""The wide orders table: declared schema, conformance and output presentation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# Column order and documented meaning of the 25-column orders table.
ORDER_COLUMNS: tuple[tuple[str, T.DataType, bool], ...] = (
    ("order_id", T.StringType(), False),
    ("customer_id", T.StringType(), True),
    ("customer_name", T.StringType(), True),
    ("customer_email", T.StringType(), True),
    ("customer_phone", T.StringType(), True),
    ("order_date", T.DateType(), True),
    ("product_id", T.StringType(), True),
    ("product_name", T.StringType(), True),
    ("product_category", T.StringType(), True),
    ("quantity", T.LongType(), True),
    ("unit_price", MONEY, True),
    ("total_amount", MONEY, True),
    ("discount_amount", MONEY, True),
    ("tax_amount", MONEY, True),
    ("final_amount", MONEY, True),
    ("shipping_address", T.StringType(), True),
    ("shipping_city", T.StringType(), True),
    ("shipping_state", T.StringType(), True),
    ("shipping_zip", T.StringType(), True),
    ("shipping_country", T.StringType(), True),
    ("order_status", T.StringType(), True),
    ("payment_method", T.StringType(), True),
    ("store_id", T.LongType(), True),
    ("sales_rep_id", T.LongType(), True),
    ("promotion_code", T.StringType(), True),
)

ORDERS_SCHEMA = T.StructType([T.StructField(n, t, nullable) for n, t, nullable in ORDER_COLUMNS])
COLUMN_NAMES: tuple[str, ...] = tuple(n for n, _, _ in ORDER_COLUMNS)
MONEY_COLUMNS: tuple[str, ...] = tuple(n for n, t, _ in ORDER_COLUMNS if t == MONEY)

# The only columns any report reads; persist these, never the full width.
USED_COLUMNS: tuple[str, ...] = (
    "order_id",
    "customer_id",
    "order_date",
    "product_name",
    "product_category",
    "final_amount",
    "shipping_state",
    "order_status",
    "payment_method",
)


class SchemaMismatch(ValueError):
    """Raised when a source lacks required order columns."""


def _conform_column(name: str, source: T.DataType, target: T.DataType, on_bad: str) -> Column:
    col = F.col(name)
    if source == target:
        return col
    if isinstance(source, (T.FloatType, T.DoubleType)):
        # NaN is "missing" for pandas users; make it NULL before any cast.
        col = F.when(F.isnan(col), F.lit(None)).otherwise(col)
    if isinstance(target, T.DateType) and isinstance(source, (T.TimestampType, T.TimestampNTZType)):
        return F.to_date(col)
    fitted = col.try_cast(target)
    if on_bad == "null":
        return fitted
    message = F.concat(F.lit(f"orders column {name}: value does not fit {target.simpleString()}: "), col.cast("string"))
    return F.when(col.isNotNull() & fitted.isNull(), F.raise_error(message).cast(target)).otherwise(fitted)


def conform(df: DataFrame, *, strict: bool = True, on_bad: str = "fail") -> DataFrame:
    """Cast a scanned orders frame to ``ORDERS_SCHEMA``.

    Casting is explicit and per column. A value that does not fit its type
    fails the query; with ``on_bad="null"`` it becomes NULL instead, and
    ``unfit_counts`` tells how many do so. Columns missing from the source raise
    ``SchemaMismatch`` when ``strict``; otherwise they are added as typed NULLs.
    Columns already of the declared type are passed through untouched, so
    parquet filter pushdown keeps working on them.
    """
    if on_bad not in ("fail", "null"):
        raise ValueError(f"on_bad must be 'fail' or 'null', not {on_bad!r}")
    present_types = {f.name: f.dataType for f in df.schema.fields}
    missing = [n for n in COLUMN_NAMES if n not in present_types]
    if missing and strict:
        raise SchemaMismatch(f"orders source lacks columns: {missing}")
    cols = []
    for name, target, _ in ORDER_COLUMNS:
        if name in present_types:
            cols.append(_conform_column(name, present_types[name], target, on_bad).alias(name))
        else:
            cols.append(F.lit(None).cast(target).alias(name))
    return df.select(*cols)


def unfit_counts(df: DataFrame) -> DataFrame:
    """One row: per order column of ``df`` how many values ``conform(on_bad="null")`` would turn into NULL."""
    types = {f.name: f.dataType for f in df.schema.fields}

    def lost(name: str, target: T.DataType) -> Column:
        source = F.col(name)
        if isinstance(types[name], (T.FloatType, T.DoubleType)):
            source = F.when(~F.isnan(source), source)
        return F.count_if(source.isNotNull() & _conform_column(name, types[name], target, "null").isNull())

    return df.agg(*[lost(n, t).alias(n) for n, t, _ in ORDER_COLUMNS if n in types])


def present(df: DataFrame) -> DataFrame:
    """Render a result for exchange: decimals as double, dates as ISO text.

    Money stays exact DECIMAL(18,2) through every aggregation; only the final,
    already aggregated values are converted.
    """
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
