"""Seasonal trends: every month of the span, compared with the year before and with the average month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions.dates import month_label, month_start
from ordersight.operators.charts import revenue


def seasonal_trend(df: DataFrame) -> DataFrame:
    """One row per month from the first to the last order, months without orders included.

    order_month, order_count, revenue; last_year (revenue twelve months before,
    NULL in the first year), change (relative to it, NULL if that was 0);
    seasonal_index: the mean revenue of this calendar month over all years,
    relative to the mean of all months (NULL if that is 0). Orders without a
    date are left out; without any dates there are no rows. Windows run over
    the grouped rows only, one a month.
    """
    monthly = df.where(F.col("order_date").isNotNull()).groupBy(month_start(F.col("order_date")).alias("month")).agg(F.count(F.lit(1)).alias("n"), revenue().alias("amount"))
    span = monthly.agg(F.min("month").alias("first"), F.max("month").alias("last")).where(F.col("first").isNotNull())
    spine = span.select(F.explode(F.sequence("first", "last", F.expr("interval 1 month"))).alias("month"))
    dense = spine.join(monthly, "month", "left").select(
        "month", F.coalesce("n", F.lit(0)).alias("order_count"), F.coalesce("amount", F.lit(0)).cast("decimal(28,2)").alias("amount")
    )
    in_time = Window.orderBy("month")
    of_season = Window.partitionBy(F.month("month"))
    whole = Window.partitionBy()

    def total(over) -> Column:
        return F.sum("amount").over(over).cast("double")

    def months(over) -> Column:
        return F.count(F.lit(1)).over(over)

    out = dense.select(
        "month",
        "order_count",
        "amount",
        F.lag("amount", 12).over(in_time).alias("before"),
        (total(of_season) * months(whole)).alias("season"),
        (total(whole) * months(of_season)).alias("average"),
    )
    return out.select(
        month_label(F.col("month")).alias("order_month"),
        "order_count",
        F.col("amount").cast("double").alias("revenue"),
        F.col("before").cast("double").alias("last_year"),
        F.when(F.col("before") != 0, (F.col("amount") - F.col("before")).cast("double") / F.col("before").cast("double")).alias("change"),
        F.when(F.col("average") != 0, F.col("season") / F.col("average")).alias("seasonal_index"),
    ).orderBy("order_month")
