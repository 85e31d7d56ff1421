"""Orders by place: countries, their states and the total in one pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordersight.operators.charts import revenue

#: ``grouping_id()`` of the levels of the rollup.
LEVELS = {0: "state", 1: "country", 3: "total"}


def geo_rollup(df: DataFrame) -> DataFrame:
    """level, shipping_country, shipping_state, order_count, customers, revenue, share_of_parent.

    One ``rollup`` gives states, countries and the total; ``level`` tells a rolled-up
    column from a NULL place, which is a place like any other. The share is of
    the level above (NULL for the total, or where that sold nothing) and comes
    from the grouped rows, not from another pass. An empty input gives its total.
    """
    sums = df.rollup("shipping_country", "shipping_state").agg(
        F.count(F.lit(1)).alias("order_count"),
        F.count_distinct("customer_id").alias("customers"),
        revenue().alias("amount"),
        F.grouping_id().alias("gid"),
    )
    # A country and its states share a partition; the total stands alone.
    of_country = F.max(F.when(F.col("gid") == 1, F.col("amount"))).over(Window.partitionBy("shipping_country", F.col("gid") == 3))
    of_all = F.max(F.when(F.col("gid") == 3, F.col("amount"))).over(Window.partitionBy())
    parent = F.when(F.col("gid") == 0, of_country).when(F.col("gid") == 1, of_all)
    level = F.coalesce(*[F.when(F.col("gid") == g, F.lit(name)) for g, name in LEVELS.items()])
    return sums.select(
        level.alias("level"),
        "shipping_country",
        "shipping_state",
        "order_count",
        "customers",
        F.col("amount").cast("double").alias("revenue"),
        F.when(parent != 0, F.col("amount").cast("double") / parent.cast("double")).alias("share_of_parent"),
    )
