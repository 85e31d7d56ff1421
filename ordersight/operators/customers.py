"""Customer lifetime value with exact ranks and value bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersight.operators.charts import revenue
from ordersight.operators.ranking import band, numbered


def customer_value(df: DataFrame) -> DataFrame:
    """One row per customer: orders, lifetime value, average order, first and last date; orders without a customer are left out."""
    return (
        df.where(F.col("customer_id").isNotNull())
        .groupBy("customer_id")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            revenue().alias("lifetime_value"),
            F.count("final_amount").alias("_amounts"),
            F.min("order_date").alias("first_order"),
            F.max("order_date").alias("last_order"),
        )
        .withColumn("avg_order_value", F.when(F.col("_amounts") > 0, F.col("lifetime_value").cast("double") / F.col("_amounts")))
        .select("customer_id", "order_count", "lifetime_value", "avg_order_value", "first_order", "last_order")
    )


def customer_value_bands(df: DataFrame, bands: int = 10) -> DataFrame:
    """``customer_value`` with ``value_rank`` and ``value_band``, 1 the most valuable; ties rank by customer.

    Bands are those of ``ntile``: equal sizes, the first ones take the rest.
    Customers are ranked by a range partition, so no task sees them all.
    """
    if bands < 1:
        raise ValueError("bands must be >= 1")
    ranked = numbered(customer_value(df), [("lifetime_value", "desc"), "customer_id"], number="value_rank", size="customers")
    return ranked.withColumn("value_band", band(F.col("value_rank"), F.col("customers"), bands)).drop("customers")
