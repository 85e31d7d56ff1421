"""Writers that keep a promise: one named file, files of a size, verified rows, a lake by month; loads that notice changed files."""

from __future__ import annotations

import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from ordersight.schema import ORDERS_SCHEMA, USED_COLUMNS
from ordersight.sinks.files import (
    WriteMismatch,
    export_lake,
    read_csv,
    read_lake,
    verify_written,
    write_named_csv,
    write_target_size,
    write_verified,
)
from ordersight.sources.cache import loaded, unload
from ordersight.sources.synth import generate_orders


def test_one_csv_file_under_its_name(spark, tmp_dir):
    df = generate_orders(spark, 50)
    now = dt.datetime(2024, 5, 6, 7, 8, 9)
    path = write_named_csv(df, tmp_dir, now)
    assert path == f"{tmp_dir}/filtered_orders_data_20240506_070809.csv"
    assert [f for f in os.listdir(tmp_dir) if not f.startswith(".")] == [os.path.basename(path)]
    with open(path, "rb") as f:
        assert f.read().split(b"\n")[0].decode().split(",") == df.columns
    assert read_csv(spark, path, ORDERS_SCHEMA).count() == 50
    with pytest.raises(FileExistsError):
        write_named_csv(df, tmp_dir, now)


@pytest.mark.parametrize("target", [60_000, 200_000])
def test_files_have_the_wanted_size_on_skewed_input(spark, tmp_dir, target):
    big = generate_orders(spark, 12_000, partitions=1).unionByName(generate_orders(spark, 300, seed=2, partitions=7))
    big.write.parquet(tmp_dir + "/in")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sizes = [r["size_bytes"] for r in write_target_size(spark.read.parquet(tmp_dir + "/in"), tmp_dir + "/out", target).collect()]
    assert spark.read.parquet(tmp_dir + "/out").count() == 12_300
    assert len(sizes) > 3 and all(abs(s - target) <= 0.25 * target for s in sorted(sizes)[1:])
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == before


def test_target_size_of_nothing(spark, tmp_dir):
    empty = generate_orders(spark, 10).where("false")
    write_target_size(empty, tmp_dir + "/out", 1000)
    assert spark.read.parquet(tmp_dir + "/out").count() == 0
    with pytest.raises(ValueError):
        write_target_size(empty, tmp_dir + "/out", 0)


def test_a_verified_write_counts_what_it_wrote(spark, tmp_dir):
    df = generate_orders(spark, 500, partitions=4)
    [row] = write_verified(df, tmp_dir + "/v").collect()
    assert row["rows"] == 500 and row["checksum"] is not None
    [again] = write_verified(df.repartition(3), tmp_dir + "/w").collect()
    assert again == row
    [empty] = write_verified(df.where("false"), tmp_dir + "/e").collect()
    assert (empty["rows"], empty["checksum"]) == (0, 0)


def test_a_removed_or_changed_file_is_noticed(spark, tmp_dir):
    df, path = generate_orders(spark, 500, partitions=4), tmp_dir + "/v"
    [row] = write_verified(df, path).collect()
    some = sorted(glob.glob(path + "/part-*.parquet"))
    with open(some[0], "rb") as f:
        kept = f.read()
    os.remove(some[0])
    with pytest.raises(WriteMismatch):
        verify_written(spark, path, row["rows"], row["checksum"], df.schema)
    with open(some[0], "wb") as f:
        f.write(kept)
    verify_written(spark, path, row["rows"], row["checksum"], df.schema)
    with pytest.raises(WriteMismatch):
        verify_written(spark, path, row["rows"], row["checksum"] + 1, df.schema)
    with pytest.raises(ValueError):
        write_verified(df, path, "append")


def test_the_checksum_sees_where_nulls_are(spark, tmp_dir):
    sums = [write_verified(spark.createDataFrame([r], "a string, b string"), f"{tmp_dir}/{i}").first()["checksum"] for i, r in enumerate([("x", None), (None, "x"), ("x", "")])]
    assert len(set(sums)) == 3


def test_a_rerun_replaces_its_months_only(spark, tmp_dir, orders):
    path = tmp_dir + "/lake"
    dates = [dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5), None]
    df = orders([{"order_id": f"o{i}", "order_date": d} for i, d in enumerate(dates)])
    export_lake(df, path)
    export_lake(df.where(F.month("order_date") == 2).withColumn("order_status", F.lit("New")), path)
    got = {r["order_id"]: (r["order_month"], r["order_status"]) for r in read_lake(spark, path).collect()}
    assert got == {"o0": ("2024-01", "Shipped"), "o1": ("2024-02", "New"), "o2": ("2024-03", "Shipped"), "o3": (None, "Shipped")}
    some = read_lake(spark, path, "2024-02", "2024-02")
    assert [r["order_id"] for r in some.collect()] == ["o1"]
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and ">= 2024-02" in plan


def test_replaced_files_lead_to_a_new_load(spark, tmp_dir):
    path = tmp_dir + "/d"
    generate_orders(spark, 40).write.parquet(path)
    first = loaded(spark, path, materialise=True)
    assert first is loaded(spark, path) and first.columns == list(USED_COLUMNS)
    assert "InMemoryTableScan" in first.groupBy().count()._jdf.queryExecution().executedPlan().toString()
    # another process replaces the files: Spark's session is not told
    generate_orders(spark, 70, seed=9).write.parquet(tmp_dir + "/new")
    for old in glob.glob(path + "/*.parquet"):
        os.remove(old)
    for new in glob.glob(tmp_dir + "/new/*.parquet"):
        with open(new, "rb") as a, open(f"{path}/{os.path.basename(new)}", "wb") as b:
            b.write(a.read())
    second = loaded(spark, path, materialise=True)
    assert second is not first and second.count() == 70
    assert unload(spark, path) and not unload(spark, path)
