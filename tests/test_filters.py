"""Filter semantics (empty selection, one-date range, NULLs, guards, limit)."""

from __future__ import annotations

import datetime as dt

import pytest

from ordersight.operators.filters import (
    OrderFilter,
    apply_filter,
    filter_bounds,
    filter_options,
    filter_predicate,
)


def _ids(df):
    return sorted(r["order_id"] for r in df.select("order_id").collect())


def test_empty_selection_means_no_filter(orders):
    df = orders([{"product_category": "Books"}, {"product_category": "Toys"}])
    out = apply_filter(df, OrderFilter(categories=(), statuses=None, payment_methods=()))
    assert out.count() == 2


def test_single_date_is_no_date_filter(orders):
    df = orders([{"order_date": dt.date(2020, 1, 1)}, {"order_date": dt.date(2024, 1, 1)}])
    assert apply_filter(df, OrderFilter(date_range=("2024-01-01",))).count() == 2
    assert apply_filter(df, OrderFilter(date_range=("2024-01-01", "2024-12-31"))).count() == 1


def test_date_range_is_inclusive_on_both_ends(orders):
    df = orders([{"order_date": dt.date(2024, 1, d)} for d in (1, 2, 3, 4)])
    out = apply_filter(df, OrderFilter(date_range=(dt.date(2024, 1, 2), dt.date(2024, 1, 3))))
    assert out.count() == 2


def test_nulls_never_pass_in_lists_or_ranges(orders):
    df = orders(
        [
            {"order_status": None},
            {"order_status": "Shipped"},
            {"final_amount": None},
            {"order_date": None},
        ]
    )
    # selecting every non-null value still drops the NULL status
    assert apply_filter(df, OrderFilter(statuses=("Shipped",))).count() == 3
    assert apply_filter(df, OrderFilter(amount_range=(0, 1e9))).count() == 3
    assert apply_filter(df, OrderFilter(date_range=("1900-01-01", "2100-01-01"))).count() == 3


def test_amount_range_inclusive(orders):
    df = orders([{"final_amount": "10.00"}, {"final_amount": "20.00"}, {"final_amount": "20.01"}])
    assert apply_filter(df, OrderFilter(amount_range=(10.0, 20.0))).count() == 2


def test_amount_edges_are_exact_decimals(orders):
    df = orders([{"final_amount": a} for a in ("10.00", "10.01", "19.99", "20.00", "20.01", "-5.00")])
    keep = lambda lo, hi: apply_filter(df, OrderFilter(amount_range=(lo, hi))).count()
    assert keep(10.005, 19.999) == 2
    assert keep(0.1 + 0.2, 20.0) == 4
    assert keep(float("-inf"), float("inf")) == 6
    assert keep(-1e30, 1e30) == 6
    with pytest.raises(ValueError):
        filter_predicate(OrderFilter(amount_range=(float("nan"), 1.0)), df.columns)


def test_bounds_of_absent_columns_are_absent(orders):
    df = orders([{}, {}])
    assert filter_bounds(df.drop("final_amount")).columns == ["min_date", "max_date", "n_dates"]
    assert filter_bounds(df.drop("order_date")).columns == ["min_amount", "max_amount"]
    assert filter_bounds(df.drop("order_date", "final_amount")).first()["n_rows"] == 2


def test_missing_column_skips_predicate(orders):
    df = orders([{"payment_method": "Cash"}, {"payment_method": "PayPal"}]).drop("payment_method")
    assert filter_predicate(OrderFilter(payment_methods=("Cash",)), df.columns) is None
    assert apply_filter(df, OrderFilter(payment_methods=("Cash",))).count() == 2


def test_adding_a_predicate_never_adds_rows(orders):
    df = orders(
        [{"order_status": s, "payment_method": p} for s in ("Shipped", "Pending") for p in ("Cash", "PayPal")]
    )
    a = apply_filter(df, OrderFilter(statuses=("Shipped",))).count()
    b = apply_filter(df, OrderFilter(statuses=("Shipped",), payment_methods=("Cash",))).count()
    assert b <= a <= df.count()


def test_row_limit_takes_first_ids(orders):
    df = orders([{} for _ in range(30)])
    out = apply_filter(df, OrderFilter(row_limit=10))
    assert _ids(out) == [f"o{i:03d}" for i in range(10)]


def test_bounds_and_options(orders):
    df = orders(
        [
            {"order_date": dt.date(2024, 1, 1), "final_amount": "5.00", "order_status": None},
            {"order_date": dt.date(2024, 3, 1), "final_amount": "50.00", "order_status": "Pending"},
            {"order_date": None, "final_amount": None, "order_status": "Shipped"},
        ]
    )
    b = filter_bounds(df).first()
    assert (b["min_date"], b["max_date"]) == (dt.date(2024, 1, 1), dt.date(2024, 3, 1))
    assert (float(b["min_amount"]), float(b["max_amount"]), b["n_dates"]) == (5.0, 50.0, 2)
    opts = {(r["picker"], r["value"]) for r in filter_options(df).collect()}
    assert ("status", "Pending") in opts and ("status", "Shipped") in opts
    assert all(v is not None for _, v in opts)


def test_default_filter_is_identity_on_null_free_data(orders):
    df = orders([{"order_status": s, "payment_method": p, "product_category": c}
                 for s in ("A", "B") for p in ("X", "Y") for c in ("K", "L")])
    assert apply_filter(df, OrderFilter()).count() == df.count()
    every = OrderFilter(
        statuses=("A", "B"), payment_methods=("X", "Y"), categories=("K", "L"),
        date_range=("1900-01-01", "2100-12-31"), amount_range=(-1e12, 1e12),
    )
    assert _ids(apply_filter(df, every)) == _ids(df)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_row = st.fixed_dictionaries(
    {
        "order_status": st.sampled_from(["A", "B", "C", None]),
        "payment_method": st.sampled_from(["X", "Y", None]),
        "final_amount": st.one_of(st.none(), st.integers(0, 500).map(lambda c: f"{c / 10:.2f}")),
        "order_date": st.one_of(st.none(), st.dates(dt.date(2024, 1, 1), dt.date(2024, 3, 31))),
    }
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    rows=st.lists(_row, min_size=0, max_size=25),
    statuses=st.lists(st.sampled_from(["A", "B", "C"]), max_size=2, unique=True),
    pays=st.lists(st.sampled_from(["X", "Y"]), max_size=1, unique=True),
    lo=st.integers(0, 50),
    span=st.integers(0, 50),
    with_dates=st.booleans(),
)
def test_filter_matches_python_reference(orders, rows, statuses, pays, lo, span, with_dates):
    from decimal import Decimal

    d_lo, d_hi = dt.date(2024, 1, 15), dt.date(2024, 2, 20)
    filt = OrderFilter(
        statuses=tuple(statuses) or None,
        payment_methods=tuple(pays) or None,
        amount_range=(float(lo), float(lo + span)),
        date_range=(d_lo, d_hi) if with_dates else None,
    )
    df = orders(rows)

    def keep(r):
        if statuses and r["order_status"] not in statuses:
            return False
        if pays and r["payment_method"] not in pays:
            return False
        a = r["final_amount"]
        if a is None or not (lo <= Decimal(a) <= lo + span):
            return False
        if with_dates and (r["order_date"] is None or not (d_lo <= r["order_date"] <= d_hi)):
            return False
        return True

    want = sorted(f"o{i:03d}" for i, r in enumerate(rows) if keep(r))
    assert _ids(apply_filter(df, filt)) == want
