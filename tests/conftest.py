from __future__ import annotations

import datetime as dt
import os
import sys
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import types as T

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from ordersight.schema import COLUMN_NAMES, ORDERS_SCHEMA  # noqa: E402
from ordersight.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=8)
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="ordersight-test-"))
    yield s


@pytest.fixture
def tmp_dir():
    return tempfile.mkdtemp(prefix="ordersight-t-")


_DEFAULTS = {
    "order_id": None,
    "customer_id": "c1",
    "customer_name": "Ada Adams",
    "customer_email": "ada@example.com",
    "customer_phone": "(200) 000-0000",
    "order_date": dt.date(2024, 1, 15),
    "product_id": "p1",
    "product_name": "Laptop",
    "product_category": "Electronics",
    "quantity": 1,
    "unit_price": Decimal("10.00"),
    "total_amount": Decimal("10.00"),
    "discount_amount": Decimal("0.00"),
    "tax_amount": Decimal("0.80"),
    "final_amount": Decimal("10.80"),
    "shipping_address": "1 Oak St",
    "shipping_city": "Salem",
    "shipping_state": "Oregon",
    "shipping_zip": "01234",
    "shipping_country": "United States",
    "order_status": "Shipped",
    "payment_method": "Cash",
    "store_id": 1000,
    "sales_rep_id": 100,
    "promotion_code": None,
}


def make_orders(spark, rows: list[dict]):
    """Orders frame in the declared schema; unspecified columns get defaults."""
    data = []
    for i, r in enumerate(rows):
        full = {**_DEFAULTS, "order_id": f"o{i:03d}", **r}
        for k in ("unit_price", "total_amount", "discount_amount", "tax_amount", "final_amount"):
            if isinstance(full[k], (int, float, str)):
                full[k] = Decimal(str(full[k]))
        data.append(tuple(full[c] for c in COLUMN_NAMES))
    nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in ORDERS_SCHEMA])
    return spark.createDataFrame(data, nullable)


@pytest.fixture
def orders(spark):
    return lambda rows: make_orders(spark, rows)
