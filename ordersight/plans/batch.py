"""The batch job: load, inventory, schema, first rows, total, five reports, sample export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.functions.dates import month_label, month_start
from ordersight.operators import reports
from ordersight.operators.ordering import sort_by_measure, top_k
from ordersight.operators.tables import first_rows, schema_frame
from ordersight.plans.shared import grain, grouped_once, total_row
from ordersight.sinks.files import write_sample
from ordersight.sources.parquet import file_inventory, read_orders

SAMPLE_ROWS = 100
REPORT_GRAINS = ("order_status", "product_category", "_month", "payment_method", "shipping_state")


def report_pack(df: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """The five batch reports and the overview from ONE scan of ``df``.

    Same rows as ``reports.orders_by_status`` & co. run one by one.
    """
    base = df.select(
        "order_status", "product_category", month_start(F.col("order_date")).alias("_month"),
        "payment_method", "shipping_state", "final_amount",
    )
    agg = grouped_once(
        base,
        REPORT_GRAINS,
        [
            F.count(F.lit(1)).alias("order_count"),
            F.sum("final_amount").alias("total_revenue"),
            F.count("final_amount").alias("_n_amount"),
        ],
        include_total=True,
        materialize=materialize,
    )

    def part(name: str) -> DataFrame:
        return grain(agg, REPORT_GRAINS, name)

    monthly = part("_month").select(
        month_label(F.col("_month")).alias("order_month"), "order_count", "total_revenue"
    ).orderBy(F.asc_nulls_first("order_month"))
    payment = part("payment_method").select(
        "payment_method", "order_count",
        reports.average(F.col("total_revenue"), F.col("_n_amount")).alias("avg_order_value"),
    )
    total = total_row(agg, REPORT_GRAINS).select(
        F.col("order_count").alias("total_rows"), F.lit(len(df.columns)).alias("total_columns")
    )
    return {
        "overview": total,
        "orders_by_status": sort_by_measure(
            part("order_status").drop("_n_amount"), "order_count", ["order_status"]
        ),
        "category_revenue": sort_by_measure(
            part("product_category").drop("_n_amount"), "total_revenue", ["product_category"]
        ),
        "monthly_trend": monthly,
        "payment_distribution": sort_by_measure(payment, "order_count", ["payment_method"]),
        "top_states": top_k(
            part("shipping_state").select("shipping_state", "order_count"), "order_count", ["shipping_state"], 20
        ),
    }


def run_batch(spark: SparkSession, source: str, sample_path: str | None = None) -> dict[str, DataFrame]:
    """The whole batch job; the total and the five reports share one pass over the orders."""
    df = read_orders(spark, source)
    out = {
        "inventory": file_inventory(spark, source),
        "schema": schema_frame(df),
        "first_rows": first_rows(df, SAMPLE_ROWS),
        **report_pack(df),
    }
    if sample_path:
        write_sample(df, sample_path, SAMPLE_ROWS)
    return out
