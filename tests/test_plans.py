"""Plans: shared-scan packs equal the single reports; plan shapes at scan."""

from __future__ import annotations

import uuid

import pytest

from ordersight.operators import charts, reports
from ordersight.operators.filters import OrderFilter, apply_filter, filter_bounds, filter_options
from ordersight.operators.histogram import amount_histogram
from ordersight.plans.batch import report_pack, run_batch
from ordersight.plans.dashboard import chart_pack, dashboard
from ordersight.plans.registry import DEMO_FILTER
from ordersight.sources.parquet import read_orders
from ordersight.sources.star import orders_from_star
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def wide_path(spark):
    import tempfile

    path = tempfile.mkdtemp(prefix="ordersight-wide-") + "/orders"
    orders_from_star(spark, SF_SMALL).write.parquet(path)
    return path


def _same(a, b):
    assert a.columns == b.columns
    assert a.collect() == b.collect()


def test_report_pack_equals_single_reports(spark, wide_path):
    df = read_orders(spark, wide_path)
    pack = report_pack(df)
    for name in ("orders_by_status", "category_revenue", "monthly_trend", "payment_distribution", "top_states"):
        _same(pack[name], getattr(reports, name)(df))


def test_chart_pack_equals_single_charts(spark, orders, wide_path):
    df = read_orders(spark, wide_path).unionByName(orders([{"order_status": None, "shipping_state": None}]))
    pack = chart_pack(df)
    for name in ("status_share", "payment_counts", "category_revenue_chart", "top_products", "daily_trend",
                 "top_states_orders", "top_states_revenue"):
        _same(pack[name], getattr(charts, name)(df))


def test_dashboard_equals_single_operators(spark, wide_path):
    df = read_orders(spark, wide_path)
    limited = dashboard(df, OrderFilter(**{**DEMO_FILTER.__dict__, "row_limit": 50}))
    assert limited["kpis"].first()["total_orders"] <= 50
    assert limited["table"].count() <= 50
    full = dashboard(df, DEMO_FILTER)
    filtered = apply_filter(df, DEMO_FILTER)
    _same(full["kpis"], charts.kpis(filtered))
    _same(full["kpi_formatted"], charts.kpi_formatted(filtered))
    _same(full["amount_histogram"], amount_histogram(filtered))
    _same(full["bounds"], filter_bounds(df))
    _same(full["options"], filter_options(df))
    assert full["table"].count() == filtered.count()
    assert full["kpis"].first()["total_orders"] == apply_filter(df, DEMO_FILTER).count()
    assert set(full) >= {"bounds", "options", "kpis", "amount_histogram", "table", "daily_trend"}


def test_dashboard_without_a_column_drops_only_its_outputs(spark, wide_path):
    df = read_orders(spark, wide_path)
    whole = set(dashboard(df, DEMO_FILTER))
    gone = {
        "payment_method": {"payment_counts"},
        "order_date": {"daily_trend"},
        "customer_id": {"kpis", "kpi_formatted"},
        "final_amount": {"kpis", "kpi_formatted", "amount_histogram", "category_revenue_chart", "top_products", "daily_trend", "top_states_orders", "top_states_revenue"},
    }
    for column, lost in gone.items():
        out = dashboard(df.drop(column), DEMO_FILTER)
        assert whole - set(out) == lost, column
        assert all(isinstance(v.collect(), list) for v in out.values())
    assert "payment_counts" not in chart_pack(df.drop("payment_method"))


def test_run_batch(spark, wide_path, tmp_dir):
    out = run_batch(spark, wide_path, tmp_dir + "/sample")
    assert tuple(out["overview"].first()) == (6000, 25)
    assert sum(r["n_rows"] for r in out["inventory"].collect()) == 6000
    assert out["schema"].count() == 25 and out["first_rows"].count() == 100
    assert read_orders(spark, tmp_dir + "/sample").count() == 100


def _plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "100000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_parquet_scan(spark, wide_path):
    df = read_orders(spark, wide_path)
    plan = _plan(apply_filter(df, DEMO_FILTER).select("order_id"))
    assert "PushedFilters" in plan
    for needle in (
        "GreaterThanOrEqual(order_date", "LessThanOrEqual(order_date", "In(order_status", "In(product_category",
        "GreaterThanOrEqual(final_amount", "LessThanOrEqual(final_amount",
    ):
        assert needle in plan, needle


def test_column_pruning_and_topk(spark, wide_path):
    df = read_orders(spark, wide_path)
    plan = _plan(reports.top_states(df))
    assert "TakeOrderedAndProject" in plan
    assert "ReadSchema: struct<shipping_state:string>" in plan


def test_no_python_udf_anywhere(spark, wide_path):
    df = read_orders(spark, wide_path)
    for out in list(report_pack(df, materialize=False).values()) + list(dashboard(df, DEMO_FILTER, materialize=False).values()):
        plan = _plan(out)
        assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_histogram_bounds_are_a_scalar_subquery(spark, wide_path):
    from ordersight.operators.histogram import amount_histogram

    df = read_orders(spark, wide_path)
    plan = _plan(amount_histogram(df))
    assert "Subquery" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_grouped_queries_pre_aggregate_before_shuffle(spark, wide_path):
    """Every keyed aggregation combines rows per task before its exchange, so a
    key holding a third of all rows still sends one row per task."""
    from ordersight.plans import registry as R

    df = read_orders(spark, wide_path)
    grouped = [
        "orders_by_status", "category_revenue", "monthly_trend", "payment_distribution", "top_states",
        "status_counts", "category_counts", "kpis", "status_share", "payment_counts",
        "category_revenue_chart", "top_products", "daily_trend", "top_states_orders", "top_states_revenue",
        "filter_options", "amount_histogram",
    ]
    for name in grouped:
        plan = _plan(R.ORDER_QUERIES[name](df))
        assert "partial_" in plan or "HashAggregate(keys=[picker" in plan, name
        assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan, name


def test_hot_key_results_are_whole(spark, orders):
    """One status holding a third of the rows: nothing dropped or capped."""
    rows = [{"order_status": "Hot", "final_amount": "1.00"} for _ in range(300)]
    rows += [{"order_status": f"s{i % 20}", "final_amount": "2.00"} for i in range(600)]
    df = orders(rows).repartition(7)
    got = {r["order_status"]: (r["order_count"], float(r["total_revenue"])) for r in reports.orders_by_status(df).collect()}
    assert got["Hot"] == (300, 300.0) and sum(v[0] for v in got.values()) == 900


def _jobs_of(spark, build) -> int:
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, "build only")
    try:
        build()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return sum(
        spark.sparkContext.statusTracker().getJobInfo(j) is not None
        for j in spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    )


def test_building_an_order_query_starts_no_job(spark):
    """Only parquet footers are read (one small job per table)."""
    from ordersight.plans import registry as R

    tables = _jobs_of(spark, lambda: orders_from_star(spark, SF_SMALL))
    assert tables <= 6
    wide = orders_from_star(spark, SF_SMALL)
    for name, fn in R.ORDER_QUERIES.items():
        assert _jobs_of(spark, lambda fn=fn: fn(wide)) == 0, name


def test_queries_that_store_while_they_are_built_are_table_queries(spark):
    from ordersight.plans import registry as R

    for name in ("co_purchase_top", "nulls_co_purchase_top", "customer_value_bands", "nulls_customer_value_bands"):
        assert name in R.TABLE_QUERIES and name not in R.ORDER_QUERIES


def test_fixture_is_never_repartitioned_by_hand(spark):
    plan = _plan(orders_from_star(spark, SF_SMALL))
    assert "REPARTITION" not in plan


def test_fixture_shuffles_line_items_twice_without_broadcasts(spark):
    """With every table too big to broadcast (the 100 TB case), line-item rows
    are shuffled on the order key and then the part key only."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = _plan(orders_from_star(spark, SF_SMALL))
    finally:
        spark.conf.set(key, old)
    lineitem_shuffles = [l for l in plan.split("\n") if "Exchange hashpartitioning(l_" in l]
    assert len(lineitem_shuffles) == 2
    assert any("l_orderkey" in l for l in lineitem_shuffles) and any("l_partkey" in l for l in lineitem_shuffles)
    assert "hashpartitioning(o_custkey" in plan  # orders, not line items, meet customers


def test_dashboard_from_path(spark, wide_path):
    from ordersight.plans.dashboard import dashboard_from_path

    full = dashboard_from_path(spark, wide_path)
    assert full["kpis"].first()["total_orders"] == 6000


def test_dashboard_approximate_customers(spark, wide_path):
    df = read_orders(spark, wide_path)
    exact = dashboard(df)["kpis"].first()["unique_customers"]
    approx = dashboard(df, approximate_customers=True)["kpis"].first()["unique_customers"]
    assert abs(approx - exact) <= 0.05 * exact
