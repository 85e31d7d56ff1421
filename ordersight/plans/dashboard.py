"""The dashboard as plans: bounds and options, filter, KPIs, charts, table.

A column that the orders lack drops only the outputs that need it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ordersight.operators import charts
from ordersight.operators.filters import PICKER_COLUMNS, OrderFilter, apply_filter, bound_measures
from ordersight.operators.histogram import amount_histogram
from ordersight.operators.ordering import sort_by_measure, top_k
from ordersight.operators.tables import table_view
from ordersight.plans.shared import grain, grouped_once, total_row
from ordersight.sources.parquet import read_orders

#: Grain of a chart -> the orders column behind it.
GRAINS = {
    "order_status": "order_status",
    "payment_method": "payment_method",
    "product_category": "product_category",
    "product_name": "product_name",
    "date": "order_date",
    "shipping_state": "shipping_state",
}


def _grouped_charts(df: DataFrame, materialize: bool) -> tuple[list[str], DataFrame]:
    """The grains that ``df`` has and one pass over it: counts and revenue per grain and in total."""
    have = set(df.columns)
    grains = [g for g, c in GRAINS.items() if c in have]
    keys = [(F.to_date("order_date") if g == "date" else F.col(GRAINS[g])).alias(g) for g in grains]
    base = df.select(*keys, *[c for c in ("order_id", "final_amount") if c in have])
    measures = [F.count(F.lit(1)).alias("n")]
    if "order_id" in have:
        measures.append(F.count("order_id").alias("order_count"))
    if "final_amount" in have:
        measures += [
            charts.revenue().alias("revenue"),
            F.count("final_amount").alias("n_amount"),
            F.min("final_amount").alias("lo"),
            F.max("final_amount").alias("hi"),
        ]
    return grains, grouped_once(base, grains, measures, include_total=True, materialize=materialize)


def _charts(grains: list[str], agg: DataFrame) -> dict[str, DataFrame]:
    have = set(agg.columns)

    def part(name: str, *columns: str) -> DataFrame | None:
        """Rows of one grain, NULL keys dropped; None if the grain or a measure is absent."""
        if name not in grains or not have.issuperset(columns):
            return None
        return grain(agg, grains, name).where(F.col(name).isNotNull()).select(name, *columns)

    def shared(p: DataFrame) -> DataFrame:
        return sort_by_measure(p.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy())), "n", ["order_status"])

    def rising(key: str, measure: str):
        return lambda p: sort_by_measure(p, measure, [key], descending=False)

    def best(key: str, measure: str, k: int):
        return lambda p: top_k(p, measure, [key], k)

    plans = {
        "status_share": (part("order_status", "n"), shared),
        "payment_counts": (part("payment_method", "n"), rising("payment_method", "n")),
        "category_revenue_chart": (part("product_category", "revenue"), rising("product_category", "revenue")),
        "top_products": (part("product_name", "revenue"), best("product_name", "revenue", 10)),
        "daily_trend": (part("date", "order_count", "revenue"), lambda p: p.orderBy("date")),
        "top_states_orders": (part("shipping_state", "order_count", "revenue"), best("shipping_state", "order_count", 15)),
        "top_states_revenue": (part("shipping_state", "revenue"), best("shipping_state", "revenue", 15)),
    }
    return {name: view(p) for name, (p, view) in plans.items() if p is not None}


def chart_pack(df: DataFrame, materialize: bool = True) -> dict[str, DataFrame]:
    """The grouped charts from ONE scan (histogram and KPIs excluded).

    Same rows as the functions in ``operators.charts``: NULL keys dropped,
    empty sums 0. Charts whose columns ``df`` lacks are left out.
    """
    return _charts(*_grouped_charts(df, materialize))


def _pickers(df: DataFrame, materialize: bool) -> dict[str, DataFrame]:
    """Slider bounds and picker options from one pass over the unfiltered orders."""
    columns = {c: tag for tag, c in PICKER_COLUMNS if c in df.columns}
    measures = bound_measures(df.columns)
    agg = grouped_once(df, list(columns), measures, include_total=True, materialize=materialize)
    out = {"bounds": total_row(agg, list(columns))}
    values = [
        grain(agg, list(columns), c).select(F.lit(tag).alias("picker"), F.col(c).cast("string").alias("value")).where("value is not null")
        for c, tag in columns.items()
    ]
    if values:
        union = values[0]
        for v in values[1:]:
            union = union.unionByName(v)
        out["options"] = union.orderBy("picker", "value")
    return out


def dashboard(
    df: DataFrame,
    filt: OrderFilter = OrderFilter(),
    *,
    materialize: bool = True,
    approximate_customers: bool = False,
) -> dict[str, DataFrame]:
    """Everything the dashboard shows.

    Bounds and options describe all orders; then filters, then the optional
    row limit, then KPIs, charts and the table. Four passes at most: one over
    all orders for bounds and options, one over the filtered ones for charts,
    KPIs and the histogram's bounds, one for distinct customers, one for the
    histogram's counts. With ``materialize`` the small results of the first
    three are computed and checkpointed here; the rest is lazy.
    ``approximate_customers`` counts distinct customers with HyperLogLog++
    (no shuffle of customer ids).
    """
    filtered = apply_filter(df, filt)
    have = set(df.columns)
    grains, agg = _grouped_charts(filtered, materialize)
    total = total_row(agg, grains)
    out = _pickers(df, materialize)
    if have >= {"customer_id", "final_amount"}:
        distinct = F.approx_count_distinct("customer_id") if approximate_customers else F.count_distinct("customer_id")
        customers = filtered.agg(distinct.alias("customers"))
        if materialize:
            customers = customers.checkpoint(eager=True)
        parts = total.select("n", "revenue", "n_amount", customers.scalar().alias("customers"))
        out["kpis"] = charts.kpis_from_parts(parts)
        out["kpi_formatted"] = charts.kpi_text_from_parts(parts)
    if "final_amount" in have:
        out["amount_histogram"] = amount_histogram(filtered, bounds=total.select("lo", "hi"))
    out["table"] = table_view(filtered)
    out.update(_charts(grains, agg))
    return out


def dashboard_from_path(
    spark: SparkSession,
    path: str,
    filt: OrderFilter = OrderFilter(),
    *,
    materialize: bool = True,
    approximate_customers: bool = False,
) -> dict[str, DataFrame]:
    """The dashboard over a parquet folder."""
    return dashboard(read_orders(spark, path), filt, materialize=materialize, approximate_customers=approximate_customers)
