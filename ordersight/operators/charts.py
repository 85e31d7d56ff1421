"""Dashboard aggregates (pandas semantics of the reference dashboard).

Differences from the batch reports are deliberate: rows whose group key is
NULL are left out (pandas ``groupby``/``value_counts`` drop them), and an
empty sum is 0 rather than NULL. Averages of nothing stay NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions.formatting import dollars, half_even_div, plain_dollars, thousands
from ordersight.operators.ordering import sort_by_measure, top_k
from ordersight.operators.reports import average
from ordersight.schema import MONEY


def revenue() -> Column:
    """Sum of ``final_amount`` with pandas' empty-sum rule (0, not NULL)."""
    return F.coalesce(F.sum("final_amount"), F.lit(0).cast(MONEY))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull())


def kpi_parts(df: DataFrame, approximate_customers: bool = False) -> DataFrame:
    """The one aggregate behind the KPI cards (a single row).

    The exact distinct count is a two-level aggregate (de-duplicated per task,
    then per key after the shuffle), so a customer holding a third of all
    orders still sends one row per task; ``approximate_customers`` switches to
    a HyperLogLog++ sketch with no shuffle of keys at all.
    """
    distinct = (
        F.approx_count_distinct("customer_id") if approximate_customers else F.count_distinct("customer_id")
    )
    return df.agg(
        F.count(F.lit(1)).alias("n"),
        revenue().alias("revenue"),
        F.count("final_amount").alias("n_amount"),
        distinct.alias("customers"),
    )


def kpis_from_parts(parts: DataFrame) -> DataFrame:
    return parts.select(
        F.col("n").alias("total_orders"),
        F.col("revenue").alias("total_revenue"),
        F.when(F.col("n_amount") > 0, average(F.col("revenue"), F.col("n_amount"))).alias("avg_order_value"),
        F.col("customers").alias("unique_customers"),
    )


def kpi_text_from_parts(parts: DataFrame) -> DataFrame:
    cents = (F.col("revenue") * F.lit(100)).cast("decimal(38,0)")
    return parts.select(
        thousands(F.col("n")).alias("total_orders"),
        dollars(cents).alias("total_revenue"),
        F.when(F.col("n_amount") > 0, plain_dollars(half_even_div(cents, F.col("n_amount")))).alias(
            "avg_order_value"
        ),
        thousands(F.col("customers")).alias("unique_customers"),
    )


def kpis(df: DataFrame, approximate_customers: bool = False) -> DataFrame:
    """Total orders, revenue, average order value and distinct customers."""
    return kpis_from_parts(kpi_parts(df, approximate_customers))


def kpi_formatted(df: DataFrame) -> DataFrame:
    """The KPI cards as text: '1,234', '$1,234.56', '$1234.56', '1,234'."""
    return kpi_text_from_parts(kpi_parts(df))


def status_share(df: DataFrame) -> DataFrame:
    """Order count per status and its share of all counted orders.

    The share's window has no partition key, but it runs over the already
    grouped rows (one per status), never over order rows.
    """
    counts = _keyed(df, "order_status").groupBy("order_status").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy())
    return sort_by_measure(counts.withColumn("share", F.col("n") / total), "n", ["order_status"])


def payment_counts(df: DataFrame) -> DataFrame:
    counts = _keyed(df, "payment_method").groupBy("payment_method").agg(F.count(F.lit(1)).alias("n"))
    return sort_by_measure(counts, "n", ["payment_method"], descending=False)


def category_revenue_chart(df: DataFrame) -> DataFrame:
    agg = _keyed(df, "product_category").groupBy("product_category").agg(revenue().alias("revenue"))
    return sort_by_measure(agg, "revenue", ["product_category"], descending=False)


def top_products(df: DataFrame, k: int = 10) -> DataFrame:
    agg = _keyed(df, "product_name").groupBy("product_name").agg(revenue().alias("revenue"))
    return top_k(agg, "revenue", ["product_name"], k)


def daily_trend(df: DataFrame) -> DataFrame:
    """Per calendar day: orders (non-null ``order_id``) and revenue."""
    return (
        _keyed(df, "order_date")
        .groupBy(F.to_date("order_date").alias("date"))
        .agg(F.count("order_id").alias("order_count"), revenue().alias("revenue"))
        .orderBy("date")
    )


def state_totals(df: DataFrame) -> DataFrame:
    return (
        _keyed(df, "shipping_state")
        .groupBy("shipping_state")
        .agg(F.count("order_id").alias("order_count"), revenue().alias("revenue"))
    )


def top_states_orders(df: DataFrame, k: int = 15) -> DataFrame:
    return top_k(state_totals(df), "order_count", ["shipping_state"], k)


def top_states_revenue(df: DataFrame, k: int = 15) -> DataFrame:
    return top_k(state_totals(df).drop("order_count"), "revenue", ["shipping_state"], k)
