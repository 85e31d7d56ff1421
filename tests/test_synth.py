"""Generator properties: shape, domains, exact amounts, partition independence."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordersight.functions.hashing import digest, half
from ordersight.schema import ORDERS_SCHEMA
from ordersight.sources.synth import PROFILES, generate_orders


@pytest.mark.parametrize("profile", ["full", "small"])
def test_generator_properties(spark, profile):
    n = 20000
    df = generate_orders(spark, n, profile=profile, partitions=4)
    assert df.schema == ORDERS_SCHEMA or [f.name for f in df.schema] == [f.name for f in ORDERS_SCHEMA]
    p = PROFILES[profile]
    stats = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("order_id").alias("ids"),
        F.sum((F.col("final_amount") != F.col("total_amount") - F.col("discount_amount") + F.col("tax_amount")).cast("int")).alias("bad_final"),
        F.min(F.col("final_amount") / F.col("total_amount")).alias("lo_ratio"),
        F.max(F.col("final_amount") / F.col("total_amount")).alias("hi_ratio"),
        F.min("unit_price").alias("min_price"),
        F.max("unit_price").alias("max_price"),
        F.avg(F.col("promotion_code").isNull().cast("double")).alias("null_promo"),
        F.min("order_date").alias("min_date"),
        F.max("quantity").alias("max_q"),
    ).first()
    assert stats["n"] == n and stats["ids"] == n and stats["bad_final"] == 0
    low = 1 - p.max_discount_pct / 100 + p.tax_pct / 100
    assert float(stats["lo_ratio"]) >= low - 0.01 and float(stats["hi_ratio"]) <= 1 + p.tax_pct / 100 + 0.01
    assert float(stats["min_price"]) >= p.price_cents[0] / 100 and float(stats["max_price"]) <= p.price_cents[1] / 100
    assert abs(stats["null_promo"] - (1 - p.promo_pct / 100)) < 0.03
    assert stats["min_date"] >= dt.date(2025, 6, 30) - dt.timedelta(days=p.days)
    assert stats["max_q"] == p.max_quantity
    pairs = {(r[0], r[1]) for r in df.select("product_category", "product_name").distinct().collect()}
    assert all(name in p.products[cat] for cat, name in pairs)
    assert {c for c, _ in pairs} == set(p.categories)
    assert {r[0] for r in df.select("order_status").distinct().collect()} == set(p.statuses)


def test_partition_independent(spark):
    a = generate_orders(spark, 3000, partitions=1).collect()
    b = generate_orders(spark, 3000, partitions=7).collect()
    assert sorted(a) == sorted(b)


def test_large_pools_are_reached(spark):
    """Ids come from 52 bits, so a pool of 10^9 customers repeats hardly any of 20,000 draws."""
    n = 20_000
    df = generate_orders(spark, n, n_customers=10**9)
    assert df.select("customer_id").distinct().count() > n - 20
    pool = spark.range(0, n).select((half(digest(42, "d", F.col("id").cast("string")), 0) % 10**9).alias("c"))
    assert pool.agg(F.max("c")).first()[0] > 9 * 10**8 > 2**26


def test_seed_changes_output(spark):
    a = generate_orders(spark, 50, seed=1).select("order_id").collect()
    b = generate_orders(spark, 50, seed=2).select("order_id").collect()
    assert a != b


def test_repeating_customers_and_products_are_consistent(spark):
    df = generate_orders(spark, 5000, n_customers=40, n_products=25)
    assert df.select("customer_id").distinct().count() <= 40
    assert df.select("product_id").distinct().count() <= 25
    per_customer = df.groupBy("customer_id").agg(F.count_distinct("customer_name", "customer_email").alias("k"))
    assert per_customer.agg(F.max("k")).first()[0] == 1
    per_product = df.groupBy("product_id").agg(F.count_distinct("product_name", "product_category").alias("k"))
    assert per_product.agg(F.max("k")).first()[0] == 1
