"""Scans (missing paths, drift, multi-folder union), inventories, writers."""

from __future__ import annotations

import datetime as dt
import os
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ordersight.operators.tables import default_columns, project_columns, schema_frame, table_view
from ordersight.schema import ORDERS_SCHEMA, SchemaMismatch, conform, unfit_counts
from ordersight.sinks.files import (
    append_orders,
    export_file_name,
    read_csv,
    write_csv,
    write_rows_per_file,
    write_sample,
    write_sized,
)
from ordersight.sources.memory import from_rows
from ordersight.sources.parquet import (
    SourceNotFound,
    file_inventory,
    file_summary,
    first_available,
    read_many,
    read_orders,
)
from ordersight.sources.synth import generate_orders


def test_missing_source_raises_typed_error(spark, tmp_dir):
    with pytest.raises(SourceNotFound):
        read_orders(spark, os.path.join(tmp_dir, "nope"))
    os.makedirs(os.path.join(tmp_dir, "empty"))
    with pytest.raises(SourceNotFound):
        read_orders(spark, os.path.join(tmp_dir, "empty"))


def test_in_memory_source(spark):
    assert from_rows(spark, [(1, "test"), (2, "data")], ["id", "value"]).count() == 2


def test_conform_casts_reference_style_files(spark, tmp_dir):
    raw = generate_orders(spark, 20).select(
        *[F.col(c).cast("double").alias(c) if c.endswith("amount") or c == "unit_price" else F.col(c) for c in ORDERS_SCHEMA.names]
    )
    raw = raw.withColumn("final_amount", F.when(F.col("order_id") == F.col("order_id"), F.lit(float("nan"))))
    raw = raw.withColumn("quantity", F.col("quantity").cast("int"))
    raw.write.parquet(tmp_dir + "/d")
    df = read_orders(spark, tmp_dir + "/d")
    assert df.schema == ORDERS_SCHEMA or [(f.name, f.dataType) for f in df.schema] == [
        (f.name, f.dataType) for f in ORDERS_SCHEMA
    ]
    assert df.where(F.col("final_amount").isNull()).count() == 20  # NaN -> NULL
    with pytest.raises(SchemaMismatch):
        conform(raw.drop("order_status"))
    assert conform(raw.drop("order_status"), strict=False).where(F.col("order_status").isNull()).count() == 20


def test_drift_across_folders(spark, tmp_dir):
    base = generate_orders(spark, 10)
    base.withColumn("quantity", F.col("quantity").cast("int")).write.parquet(tmp_dir + "/a")
    base.withColumn("extra", F.lit(1)).write.parquet(tmp_dir + "/b")
    widened = read_orders(spark, tmp_dir + "/a", tmp_dir + "/b", on_drift="widen")
    assert widened.count() == 20 and dict(widened.dtypes)["quantity"] == "bigint"
    with pytest.raises(SchemaMismatch):
        read_many(spark, [tmp_dir + "/a", tmp_dir + "/b"], conform_schema=False)
    base.write.parquet(tmp_dir + "/c")
    with pytest.raises(SchemaMismatch):
        read_many(spark, [tmp_dir + "/a", tmp_dir + "/c"])


def test_read_many_keeps_duplicates_and_skips_missing(spark, tmp_dir):
    base = generate_orders(spark, 10)
    base.write.parquet(tmp_dir + "/x")
    base.write.parquet(tmp_dir + "/y")
    df = read_many(spark, [tmp_dir + "/x", tmp_dir + "/missing", tmp_dir + "/y"])
    assert df.count() == 20 and df.select("order_id").distinct().count() == 10
    with pytest.raises(SourceNotFound):
        read_many(spark, [tmp_dir + "/missing"])


def test_first_available_and_inventory(spark, tmp_dir):
    assert first_available(spark, [tmp_dir + "/none"]) == (False, None, 0)
    generate_orders(spark, 1000, partitions=3).write.parquet(tmp_dir + "/inv")
    found, path, n = first_available(spark, [tmp_dir + "/none", tmp_dir + "/inv"])
    assert found and path.endswith("inv") and n == 3
    inv = file_inventory(spark, tmp_dir + "/inv").collect()
    assert len(inv) == 3 and sum(r["n_rows"] for r in inv) == 1000
    assert [r["file_path"] for r in inv] == sorted(r["file_path"] for r in inv)
    summary = file_summary(spark, tmp_dir + "/inv").collect()
    assert summary[-1]["file_name"] == "TOTAL" and summary[-1]["n_rows"] == 1000
    assert summary[-1]["size_bytes"] == sum(r["size_bytes"] for r in inv)


def test_sample_export_single_file(spark, tmp_dir):
    df = generate_orders(spark, 500, partitions=4)
    path = write_sample(df, tmp_dir + "/sample", 100)
    files = [f for f in os.listdir(path) if f.endswith(".parquet")]
    back = read_orders(spark, path)
    assert len(files) == 1 and back.count() == 100
    first = sorted(r[0] for r in df.select("order_id").collect())[:100]
    assert sorted(r[0] for r in back.select("order_id").collect()) == first
    write_sample(df, path, 10)  # overwrite
    assert read_orders(spark, path).count() == 10


def test_csv_round_trip(spark, orders, tmp_dir):
    df = orders(
        [
            {"customer_name": 'He said "hi", then left', "shipping_zip": "00501"},
            {"customer_name": "line\nbreak", "promotion_code": None, "order_date": dt.date(2024, 2, 29)},
            {"customer_name": None, "final_amount": Decimal("1234.50")},
        ]
    )
    cols = ["order_id", "customer_name", "order_date", "shipping_zip", "final_amount", "promotion_code"]
    path = write_csv(df, tmp_dir + "/csv", cols, single_file=True)
    schema = ORDERS_SCHEMA.__class__([ORDERS_SCHEMA[c] for c in cols])
    back = read_csv(spark, path, schema)
    assert sorted(back.collect()) == sorted(df.select(*cols).collect())
    text = open([os.path.join(path, f) for f in os.listdir(path) if f.endswith(".csv")][0]).read()
    assert '"He said ""hi"", then left"' in text and text.startswith("order_id,customer_name")
    assert export_file_name(now=dt.datetime(2024, 5, 6, 7, 8, 9)) == "filtered_orders_data_20240506_070809.csv"


def test_append_twice_and_sized_write(spark, tmp_dir):
    a, b = generate_orders(spark, 30, seed=1), generate_orders(spark, 20, seed=2)
    append_orders(a, tmp_dir + "/app")
    append_orders(b, tmp_dir + "/app")
    assert read_orders(spark, tmp_dir + "/app").count() == 50
    write_sized(generate_orders(spark, 1000), tmp_dir + "/sized", n_files=2, max_rows_per_file=300)
    inv = file_inventory(spark, tmp_dir + "/sized").collect()
    assert sum(r["n_rows"] for r in inv) == 1000 and max(r["n_rows"] for r in inv) <= 300


def test_projection_and_schema_frame(spark, orders):
    df = orders([{} for _ in range(20)])
    assert default_columns(df) == ORDERS_SCHEMA.names[:10]
    assert project_columns(df, ["order_id", "final_amount"]).columns == ["order_id", "final_amount"]
    with pytest.raises(ValueError):
        project_columns(df, [])
    assert table_view(df, n=5).count() == 5
    sf = schema_frame(df).collect()
    assert len(sf) == 25 and sf[10]["data_type"] == "decimal(18,2)"


def test_rows_per_file(spark, tmp_dir):
    write_rows_per_file(generate_orders(spark, 2000, partitions=2), tmp_dir + "/cut", 300)
    inv = file_inventory(spark, tmp_dir + "/cut").collect()
    assert sum(r["n_rows"] for r in inv) == 2000 and max(r["n_rows"] for r in inv) == 300 and len(inv) == 8
    with pytest.raises(ValueError):
        write_rows_per_file(generate_orders(spark, 1), tmp_dir + "/cut", 0)


def test_csv_keeps_blanks_empty_strings_and_nulls(spark, orders, tmp_dir):
    names = ["  lead", "trail  ", "", None, " ", 'say "hi", ok', "line\nbreak", "\ttab\t", '"', ","]
    df = orders([{"customer_name": n, "final_amount": None if n is None else Decimal("1.50")} for n in names])
    cols = ["order_id", "customer_name", "order_date", "final_amount"]
    path = write_csv(df, tmp_dir + "/csv", cols)
    schema = ORDERS_SCHEMA.__class__([ORDERS_SCHEMA[c] for c in cols])
    assert sorted(read_csv(spark, path, schema).collect()) == sorted(df.select(*cols).collect())


def test_other_files_beside_the_orders_are_ignored(spark, tmp_dir):
    generate_orders(spark, 50, partitions=2).write.parquet(tmp_dir + "/d")
    for name in ("notes.txt", "orders.csv", "broken.json"):
        with open(f"{tmp_dir}/d/{name}", "w") as f:
            f.write("not parquet")
    assert read_orders(spark, tmp_dir + "/d").count() == 50
    assert first_available(spark, [tmp_dir + "/d"])[2] == 2


def test_inventory_of_odd_paths(spark, tmp_dir):
    path = tmp_dir + "/with space & plus+"
    generate_orders(spark, 100, partitions=2).write.parquet(path)
    inv = file_inventory(spark, path).collect()
    assert len(inv) == 2 and sum(r["n_rows"] for r in inv) == 100 and all(r["size_bytes"] > 0 for r in inv)
    folder = tmp_dir + "/by"
    generate_orders(spark, 300, partitions=1).select("order_id", "order_status").write.partitionBy("order_status").parquet(folder)
    for sub in os.listdir(folder):
        for name in os.listdir(f"{folder}/{sub}") if "=" in sub else ():
            if name.endswith(".parquet"):
                os.rename(f"{folder}/{sub}/{name}", f"{folder}/{sub}/same.parquet")
    lines = file_summary(spark, folder).collect()
    assert len(lines) == 6 and lines[-1]["is_total"] and lines[-1]["n_rows"] == 300
    assert {r["file_name"] for r in lines[:-1]} == {"same.parquet"}


def test_unfit_values_fail_unless_asked_for(spark, orders):
    df = orders([{}, {}]).withColumn("final_amount", F.lit(1e20))
    with pytest.raises(Exception, match="final_amount"):
        conform(df).collect()
    assert conform(df, on_bad="null").where(F.col("final_amount").isNull()).count() == 2
    lost = unfit_counts(df.withColumn("quantity", F.lit("many"))).first()
    assert lost["final_amount"] == 2 and lost["quantity"] == 2 and lost["order_date"] == 0
    with pytest.raises(ValueError):
        conform(df, on_bad="maybe")


def test_a_load_is_kept_until_unloaded(spark, tmp_dir):
    from ordersight.schema import USED_COLUMNS
    from ordersight.sources.cache import loaded, unload

    generate_orders(spark, 100, partitions=2).write.parquet(tmp_dir + "/d")
    df = loaded(spark, tmp_dir + "/d")
    assert df is loaded(spark, tmp_dir + "/d") and df.columns == list(USED_COLUMNS)
    assert df.count() == 100 and df.storageLevel.useMemory
    assert "InMemoryTableScan" in df._jdf.queryExecution().executedPlan().toString()
    assert unload(spark, tmp_dir + "/d") and not unload(spark, tmp_dir + "/d")
    assert not df.storageLevel.useMemory


def test_single_line(spark):
    from ordersight.functions.text import single_line

    df = spark.createDataFrame([("a\nb\nc",), ("plain",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(single_line(F.col("t"))).collect()] == ["a, b, c", "plain", "", None]


def test_files_without_rows_are_in_the_inventory(spark, tmp_dir):
    path = tmp_dir + "/some empty & odd+"
    generate_orders(spark, 100, partitions=2).write.parquet(path)
    generate_orders(spark, 100, partitions=1).limit(0).write.mode("append").parquet(path)
    files = [name for name in os.listdir(path) if name.endswith(".parquet")]
    inv = {r["file_name"]: r for r in file_inventory(spark, path).collect()}
    assert sorted(inv) == sorted(files) and sorted(r["n_rows"] > 0 for r in inv.values()) == [False, True, True]
    assert all(r["size_bytes"] == os.path.getsize(f"{path}/{name}") for name, r in inv.items())
    total = file_summary(spark, path).collect()[-1]
    assert total["is_total"] and total["n_rows"] == 100 and total["size_bytes"] == sum(os.path.getsize(f"{path}/{name}") for name in files)
