"""End-to-end smoke: generate small files, scan, count, aggregate, export."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from ordersight.operators import reports
from ordersight.schema import conform
from ordersight.sinks.files import write_sample
from ordersight.sources.parquet import first_available, read_orders
from ordersight.sources.synth import SMALL_CATEGORIES, SMALL_STATUSES, generate_orders


def test_smoke_pipeline(spark, tmp_dir):
    data = tmp_dir + "/test_data"
    # three files of 1,000 rows each, like the reference's quick check
    generate_orders(spark, 3000, profile="small", partitions=3).write.parquet(data)
    found, path, n_files = first_available(spark, [tmp_dir + "/data", data])
    assert found and path == data and n_files == 3
    df = read_orders(spark, path)
    assert df.count() == 3000 and len(df.columns) == 25
    status = {r["order_status"]: r["count"] for r in reports.status_counts(df).collect()}
    assert set(status) == set(SMALL_STATUSES) and sum(status.values()) == 3000
    cats = {r["product_category"]: r["count"] for r in reports.category_counts(df).collect()}
    assert set(cats) == set(SMALL_CATEGORIES)
    out = write_sample(df, tmp_dir + "/output/sample_10_rows", 10)
    assert read_orders(spark, out).count() == 10
    assert len([f for f in os.listdir(out) if f.endswith(".parquet")]) == 1


def test_bad_values_become_null_only_on_request(spark):
    raw = generate_orders(spark, 5).withColumn("quantity", F.lit("abc")).withColumn("order_date", F.lit("not a date"))
    with pytest.raises(Exception, match="does not fit"):
        conform(raw).collect()
    df = conform(raw, on_bad="null")
    row = df.agg(F.count("quantity").alias("q"), F.count("order_date").alias("d"), F.count(F.lit(1)).alias("n")).first()
    assert (row["q"], row["d"], row["n"]) == (0, 0, 5)
