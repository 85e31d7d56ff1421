"""Batch reports vs dashboard charts: NULL groups, empty sums, ties, counts."""

from __future__ import annotations

import datetime as dt

from ordersight.operators import charts, reports
from ordersight.operators.histogram import amount_histogram


def test_batch_keeps_null_group_dashboard_drops_it(orders):
    df = orders([{"order_status": None}, {"order_status": "Shipped"}, {"order_status": "Shipped"}])
    batch = {r["order_status"]: r["order_count"] for r in reports.orders_by_status(df).collect()}
    assert batch == {None: 1, "Shipped": 2}
    share = {r["order_status"]: (r["n"], r["share"]) for r in charts.status_share(df).collect()}
    assert share == {"Shipped": (2, 1.0)}


def test_empty_sum_zero_on_dashboard_null_in_batch(orders):
    df = orders([{"product_category": "Books", "final_amount": None}])
    batch = reports.category_revenue(df).first()
    assert batch["total_revenue"] is None
    chart = charts.category_revenue_chart(df).first()
    assert float(chart["revenue"]) == 0.0
    k = charts.kpis(df).first()
    assert float(k["total_revenue"]) == 0.0 and k["avg_order_value"] is None


def test_kpis_on_empty_frame(orders):
    df = orders([{}]).limit(0)
    k = charts.kpis(df).first()
    assert k["total_orders"] == 0 and float(k["total_revenue"]) == 0.0 and k["avg_order_value"] is None
    f = charts.kpi_formatted(df).first()
    assert (f["total_orders"], f["total_revenue"], f["avg_order_value"]) == ("0", "$0.00", None)


def test_count_star_vs_count_order_id(orders):
    df = orders([{"order_id": None, "shipping_state": "Ohio"}, {"shipping_state": "Ohio"}])
    assert reports.top_states(df).first()["order_count"] == 2
    assert charts.top_states_orders(df).first()["order_count"] == 1


def test_ties_break_on_key(orders):
    rows = [{"shipping_state": s} for s in ("Utah", "Ohio", "Iowa", "Utah", "Ohio", "Iowa")]
    df = orders(rows)
    top2 = [r["shipping_state"] for r in reports.top_states(df, k=2).collect()]
    assert top2 == ["Iowa", "Ohio"]
    assert [r["shipping_state"] for r in charts.top_states_orders(df, k=2).collect()] == ["Iowa", "Ohio"]


def test_monthly_is_rollup_of_daily(orders):
    days = [dt.date(2024, m, d) for m in (1, 2, 3) for d in (1, 15, 28)]
    df = orders([{"order_date": d, "final_amount": f"{i + 1}.25"} for i, d in enumerate(days)])
    monthly = {r["order_month"]: (r["order_count"], r["total_revenue"]) for r in reports.monthly_trend(df).collect()}
    rolled: dict = {}
    for r in charts.daily_trend(df).collect():
        key = r["date"].strftime("%Y-%m")
        n, s = rolled.get(key, (0, 0))
        rolled[key] = (n + r["order_count"], s + r["revenue"])
    assert monthly == rolled


def test_group_counts_sum_to_total(orders):
    df = orders([{"product_category": c} for c in ("A", "B", "B", None, "C")])
    assert sum(r["count"] for r in reports.category_counts(df).collect()) == 5
    assert reports.overview(df).first().asDict() == {"total_rows": 5, "total_columns": 25}


def test_payment_average_is_exact_mean(orders):
    df = orders([{"payment_method": "Cash", "final_amount": a} for a in ("0.10", "0.20", "0.30")] + [
        {"payment_method": "Cash", "final_amount": None}
    ])
    r = reports.payment_distribution(df).first()
    assert r["order_count"] == 4 and r["avg_order_value"] == 0.6 / 3


def test_kpi_formatted_half_even_and_thousands(orders):
    # 0.125 average -> '$0.12' (tie to even), 1,234,567.89 total
    df = orders([{"final_amount": "0.12", "customer_id": "a"}, {"final_amount": "0.13", "customer_id": "a"}])
    f = charts.kpi_formatted(df).first()
    assert f["avg_order_value"] == "$0.12" and f["total_revenue"] == "$0.25" and f["unique_customers"] == "1"
    big = orders([{"final_amount": "1234567.89"}, {"final_amount": "-0.50"}])
    g = charts.kpi_formatted(big).first()
    assert g["total_revenue"] == "$1,234,567.39" and g["avg_order_value"] == "$617283.70"


def test_histogram_dense_closed_last_bin(orders):
    df = orders([{"final_amount": str(a)} for a in (0, 1, 2, 3, 100)] + [{"final_amount": None}])
    rows = amount_histogram(df, bins=4).collect()
    assert [r["bucket"] for r in rows] == [0, 1, 2, 3]
    assert [r["n"] for r in rows] == [4, 0, 0, 1]
    assert rows[0]["bucket_low"] == 0.0 and rows[-1]["bucket_high"] == 100.0


def test_histogram_equal_values_and_empty(orders):
    same = orders([{"final_amount": "7.00"} for _ in range(3)])
    rows = amount_histogram(same).collect()
    assert len(rows) == 50 and rows[0]["n"] == 3 and sum(r["n"] for r in rows) == 3
    empty = orders([{"final_amount": None}])
    assert amount_histogram(empty).count() == 0


def test_top_products_nlargest(orders):
    df = orders([{"product_name": f"p{i}", "final_amount": str(i % 4)} for i in range(12)])
    top = [r["product_name"] for r in charts.top_products(df, k=3).collect()]
    assert top == ["p11", "p3", "p7"]
