"""Positions without a one-task window equal a window's."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ordersight.operators.ranking import band, numbered


def _rows(spark):
    n = 5000
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 7 != 0, (F.col("id") % 11).cast("string")).alias("g"),
        F.when(F.col("id") % 13 != 0, F.pmod(F.xxhash64("id"), F.lit(400))).alias("x"),
        F.col("id").alias("tie"),
        F.lit("mine").alias("row"),
    )


@pytest.mark.parametrize("group", [(), ("g",)])
@pytest.mark.parametrize("nulls_first", [False, True])
def test_equals_a_window(spark, group, nulls_first):
    df = _rows(spark)
    got = numbered(df, ["x", ("tie", "desc")], group, nulls_first=nulls_first, size="size")
    x = F.asc_nulls_first("x") if nulls_first else F.asc_nulls_last("x")
    w = Window.partitionBy(*group)
    want = df.select("*", F.row_number().over(w.orderBy(x, F.desc("tie"))).cast("long").alias("row_number"), F.count(F.lit(1)).over(w).alias("size"))
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_equal_rows_get_different_positions_in_several_tasks(spark):
    df = spark.range(4000).select(F.lit(1).alias("x"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = numbered(df, ["x"])
        assert [r["row_number"] for r in got.orderBy("row_number").collect()] == list(range(1, 4001))
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert len(sizes) > 1 and max(sizes) < 4000


def test_empty_and_taken_names(spark):
    empty = spark.createDataFrame([], "x long")
    assert numbered(empty, ["x"]).collect() == []
    with pytest.raises(ValueError):
        numbered(spark.range(1).withColumnRenamed("id", "row_number"), ["row_number"])
    with pytest.raises(ValueError):
        numbered(spark.range(1), [("id", "up")])


@pytest.mark.parametrize("n", [1, 3, 4, 5, 17, 100])
def test_band_is_ntile(spark, n):
    w = Window.orderBy("id")
    rows = spark.range(n).select((F.col("id") + 1).alias("k"), F.lit(n).cast("long").alias("n"), F.ntile(5).over(w).cast("long").alias("want"))
    bad = rows.filter(band(F.col("k"), F.col("n"), 5) != F.col("want")).count()
    assert bad == 0
