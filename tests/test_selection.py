"""First n rows by narrowing a key range."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ordersight.operators import selection
from ordersight.operators.selection import boundary, first_n


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("first") / "rows")
    n = 40_000
    key = F.when(F.col("id") % 10 != 0, F.concat(F.lit("k"), F.lpad(F.pmod(F.xxhash64("id"), F.lit(30_000)).cast("string"), 6, "0")))
    key = F.when(F.col("id") % 3 == 0, F.lit("k015000")).otherwise(key)  # a third of the rows share a key
    spark.range(0, n, 1, 16).select(key.alias("key"), F.col("id"), F.lit("mine").alias("position")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("n", [0, 100, 15_000, 36_000, 38_500, 99_999])
def test_equals_a_sort(rows, n, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 500)
    monkeypatch.setattr(selection, "SAMPLE", 256)
    got = first_n(rows, n, "key")
    assert got.columns == rows.columns
    got = got.collect()
    want = rows.orderBy(F.asc_nulls_last("key")).limit(n).collect()
    order = lambda some: sorted((r["key"] is None, r["key"] or "") for r in some)
    assert order(got) == order(want)
    assert len({r["id"] for r in got}) == len(got)


def test_the_range_is_small_or_one_key(rows, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 500)
    for n in (100, 20_000):
        low, high, missing, held = boundary(rows, n, "key")
        keys = rows.where(selection._within(F.col("key"), low, high))
        assert held <= 500 or keys.select("key").distinct().count() == 1
        sure = rows.where(F.col("key") <= F.lit(low)).count() if low is not None else 0
        assert sure + missing == n and missing <= held


def test_no_task_merges_the_first_n_of_all_tasks(rows, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 500)
    got = first_n(rows, 7_000, "key")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" not in plan and "SinglePartition" not in plan


def test_rows_under_the_range_are_pushed_to_the_scan(rows, monkeypatch):
    monkeypatch.setattr(selection, "SMALL", 500)
    plan = first_n(rows, 7_000, "key")._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(key" in plan


def test_empty_negative_and_only_nulls(spark):
    empty = spark.createDataFrame([], "key string, x int")
    assert first_n(empty, 5, "key").collect() == []
    with pytest.raises(ValueError):
        first_n(empty, -1, "key")
    nulls = spark.range(100).select(F.lit(None).cast("string").alias("key"), "id")
    assert first_n(nulls, 30, "key").count() == 30


def test_large_limits_search_and_stay_sorted(rows):
    from ordersight.operators.ordering import ordered_limit

    got = [r["key"] for r in ordered_limit(rows, 2_500, "key").collect()]
    want = [r["key"] for r in rows.orderBy(F.asc_nulls_last("key")).limit(2_500).collect()]
    assert got == want
