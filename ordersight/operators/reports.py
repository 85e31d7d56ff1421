"""Batch reports over the whole orders table (Spark semantics: NULL keys form
their own group; the sum over an all-NULL group is NULL).

All of them aggregate partially on each task before the shuffle, so only one
small row per key per task crosses the network whatever the key skew.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.functions.dates import month_label, month_start
from ordersight.operators.ordering import sort_by_measure, top_k


def average(sum_col: Column, count_col: Column) -> Column:
    """Mean as DOUBLE from an exact decimal sum and a non-null count."""
    return sum_col.cast("double") / count_col


def _count_and_revenue(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("order_count"),
        F.sum("final_amount").alias("total_revenue"),
    )


def overview(df: DataFrame) -> DataFrame:
    """Row and column count in one row."""
    return df.agg(F.count(F.lit(1)).alias("total_rows")).select(
        "total_rows", F.lit(len(df.columns)).alias("total_columns")
    )


def orders_by_status(df: DataFrame) -> DataFrame:
    return sort_by_measure(_count_and_revenue(df, "order_status"), "order_count", ["order_status"])


def category_revenue(df: DataFrame) -> DataFrame:
    return sort_by_measure(_count_and_revenue(df, "product_category"), "total_revenue", ["product_category"])


def monthly_trend(df: DataFrame) -> DataFrame:
    """Per month ('yyyy-MM'): group on the month's first day, label after."""
    return (
        df.groupBy(month_start(F.col("order_date")).alias("_m"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("final_amount").alias("total_revenue"))
        .select(month_label(F.col("_m")).alias("order_month"), "order_count", "total_revenue")
        .orderBy(F.asc_nulls_first("order_month"))
    )


def payment_distribution(df: DataFrame) -> DataFrame:
    agg = df.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("order_count"),
        average(F.sum("final_amount"), F.count("final_amount")).alias("avg_order_value"),
    )
    return sort_by_measure(agg, "order_count", ["payment_method"])


def top_states(df: DataFrame, k: int = 20) -> DataFrame:
    agg = df.groupBy("shipping_state").agg(F.count(F.lit(1)).alias("order_count"))
    return top_k(agg, "order_count", ["shipping_state"], k)


def status_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("order_status").count()


def category_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("product_category").count()
