"""How often the registered scans and the lake store and shuffle the wide table."""

from __future__ import annotations

import datetime as dt
import os
import re
from collections import Counter

import pytest

from ordersight.plans import registry as R
from ordersight.sinks import files
from ordersight.sinks.files import export_lake, read_lake
from ordersight.sources.star import STAR_COLUMNS, orders_from_star, star_rows

DATES = [dt.date(1995, 8, 3), dt.date(1996, 2, 5), dt.date(1996, 2, 9), dt.date(1998, 3, 1), None]


@pytest.fixture(scope="module")
def star(spark, tmp_path_factory):
    """Five orders of two customers, three items each; one order has no date."""
    folder = tmp_path_factory.mktemp("star")
    tables = {
        "region": ([(1, "R")], "r_regionkey int, r_name string"),
        "nation": ([(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, f"C{c}", 1) for c in (1, 2)], "c_custkey long, c_name string, c_nationkey int"),
        "part": ([(p, f"P{p}", "T", "B", p, 9.5) for p in (1, 2, 3)], "p_partkey long, p_name string, p_type string, p_brand string, p_size int, p_retailprice double"),
        "orders": ([(o, 1 + o % 2, d, "FO"[o % 2], "1-URGENT") for o, d in enumerate(DATES)], "o_orderkey long, o_custkey long, o_orderdate date, o_orderstatus string, o_orderpriority string"),
        "lineitem": (
            [(o, p, s, p, 2.0, 10.0 * p, 0.05, 0.02, dt.date(1999, 1, 1)) for o in range(5) for p, s in ((1, 10), (2, 7), (3, 3))],
            "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate date",
        ),
    }
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def _labels(monkeypatch) -> list[str]:
    """The scratch folders that the registry asks for, as it does."""
    made, plain = [], R.scratch_path
    monkeypatch.setattr(R, "scratch_path", lambda spark, label: made.append(label) or plain(spark, label))
    return made


def test_the_union_stores_the_whole_table_once(spark, star, monkeypatch):
    made = _labels(monkeypatch)
    got = Counter(r["order_status"] for r in R.TABLE_QUERIES["scan_union"](spark, star).collect())
    assert got == {"F": 2 * 9, "O": 6}
    assert made == ["union-a", "union-b", "union-missing"]


def test_the_foreign_batches_are_written_straight_from_the_tables(spark, star, monkeypatch):
    made = _labels(monkeypatch)
    got = R.TABLE_QUERIES["scan_orders"](spark, star).collect()
    assert Counter(r["order_date"] for r in got) == {d: 3 for d in DATES}
    assert all((r["tax_amount"] is None) == (r["store_id"] == 10) for r in got)
    assert made == ["foreign"]


def test_the_lake_is_written_from_orders_stored_by_month(spark, star, monkeypatch):
    gathered, plain = [], R.export_lake
    monkeypatch.setattr(R, "export_lake", lambda df, path, **options: gathered.append(options) or plain(df, path, **options))
    got = {(r["order_month"], r["order_status"]): r["order_count"] for r in R.TABLE_QUERIES["export_lake"](spark, star).collect()}
    assert got == {("1995-08", "?"): 3, ("1996-02", "O"): 3, ("1996-02", "F"): 3}
    assert gathered == [{"gathered": True}] * 2


def test_orders_are_gathered_before_their_columns_are_written_out(spark, star):
    orders = orders_from_star(spark, star, by_month=True)
    plan = orders._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("@example.com") < plan.index("RebalancePartitions [month")
    assert sorted(orders.collect(), key=str) == sorted(orders_from_star(spark, star).collect(), key=str)


def test_gathered_months_are_written_as_they_are(spark, star, tmp_path):
    orders = orders_from_star(spark, star, by_month=True)
    for name, gathered in (("a", False), ("b", True)):
        export_lake(orders, f"{tmp_path}/{name}", gathered=gathered)
    a, b = (sorted(map(str, read_lake(spark, f"{tmp_path}/{name}").collect())) for name in "ab")
    assert a == b and len(a) == 15
    assert {len([f for f in files if f.endswith(".parquet")]) for where, _, files in os.walk(f"{tmp_path}/b") if "order_month=" in where} == {1}


def test_what_follows_from_other_columns_is_not_stored_by_month(spark, star, monkeypatch):
    paths, plain = [], R.scratch_path
    monkeypatch.setattr(R, "scratch_path", lambda spark, label: paths.append(plain(spark, label)) or paths[-1])
    before = {k: spark.conf.get(k, None) for k in R.SHUFFLES_GO}
    wide = R._stored_orders(spark, star, by_month=True)
    assert spark.read.parquet(*paths).columns == list(STAR_COLUMNS)
    assert before == {k: spark.conf.get(k, None) for k in R.SHUFFLES_GO}
    plain_orders = orders_from_star(spark, star)
    assert wide.dtypes == plain_orders.dtypes
    assert sorted(wide.collect(), key=str) == sorted(plain_orders.collect(), key=str)


def test_rows_meet_parts_then_orders_and_are_gathered_with_the_columns_of_an_order_first(spark, star):
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = star_rows(spark, star, by_month=True)._jdf.queryExecution().executedPlan().toString().split("\n")
    finally:
        spark.conf.set(key, old)
    shuffles = [re.search(r"hashpartitioning\((l_\w+key|month)", line) for line in plan]
    assert [m.group(1) for m in shuffles if m] == ["month", "l_orderkey", "l_partkey"]
    gathered = next(i for i, line in enumerate(plan) if "hashpartitioning(month" in line)
    assert re.findall(r"[a-z]_\w+?(?=#|,)", plan[gathered + 1])[:3] == ["o_orderdate", "l_orderkey", "o_custkey"]


def test_a_task_writes_several_months_side_by_side(spark, star, tmp_path, monkeypatch):
    orders = orders_from_star(spark, star).coalesce(1)
    seen, plain = [], files.settings
    for most in (32, 1, 0):
        path = f"{tmp_path}/{most}"
        monkeypatch.setattr(files, "OPEN_MONTHS", most)
        monkeypatch.setattr(files, "settings", lambda spark, wanted: seen.append(wanted) or plain(spark, wanted))
        export_lake(orders, path, gathered=True)
        assert seen.pop() == {"spark.sql.maxConcurrentOutputFileWriters": str(most)}
        got = Counter(r["order_month"] for r in read_lake(spark, path).collect())
        assert got == {"1995-08": 3, "1996-02": 6, "1998-03": 3, None: 3}
        assert {len([f for f in names if f.endswith(".parquet")]) for where, _, names in os.walk(path) if "order_month=" in where} == {1}
