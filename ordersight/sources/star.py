"""Wide orders view over the TPC-H-like star schema in ``/root/testdata``.

One row per line item: lineitem, orders, customer, nation, region and part.
Every join is left to the planner, whose broadcast threshold is the size
check (AQE re-checks it with runtime sizes); beyond it the joins shuffle on
their keys and stay eligible for AQE's skew-join splitting of a hot key.
Column pruning flows through the joins, so a report that needs three columns
reads only the source columns behind them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.functions.dates import month_label
from ordersight.functions.money import money, rate, round_money

STAR_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

#: What the orders table is made of; those of an order first, so that lines of one order have long stretches in common.
STAR_COLUMNS = (
    "l_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_name", "n_name", "r_name",
    "l_linenumber", "l_quantity", "l_discount", "l_tax", "l_extendedprice", "l_suppkey", "l_shipdate", "l_partkey",
    "p_retailprice", "p_promotion", "p_name", "p_type",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col: str) -> Column:
    return F.col(col).cast("string")


def line_order_id() -> Column:
    """Unique line key: order, line number, part, supplier and ship date."""
    return F.concat_ws(
        "-",
        _s("l_orderkey"),
        _s("l_linenumber"),
        _s("l_partkey"),
        _s("l_suppkey"),
        F.date_format("l_shipdate", "yyyyMMdd"),
    )


def star_rows(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """The source columns behind the orders table, one row per line item; ``order_columns`` makes the orders of them.

    With ``by_month`` line items meet parts first and orders last: the lines of
    an order then lie side by side, so that its columns pack well in the
    shuffle that gathers rows by the month of the order (``REBALANCE``, which
    splits a large month by size) and in files of them.
    """
    li = read_table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.to_date("l_shipdate"))
    orders = read_table(spark, sf_dir, "orders").withColumn("o_orderdate", F.to_date("o_orderdate"))
    customer = read_table(spark, sf_dir, "customer")
    nation = read_table(spark, sf_dir, "nation")
    region = read_table(spark, sf_dir, "region")
    part = read_table(spark, sf_dir, "part").withColumn("p_promotion", F.when(F.col("p_size") % 10 < 3, F.col("p_brand")))

    # Join order is deliberate (no cost-based reordering by default): orders
    # meet customers first, so line-item-level rows shuffle only twice at
    # scale (on the order key, then the part key), never on the customer key.
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey)
    cust = customer.join(geo, customer.c_nationkey == geo.n_nationkey)
    order_cust = orders.join(cust, orders.o_custkey == cust.c_custkey)
    if by_month:
        rows = li.join(part, li.l_partkey == part.p_partkey).join(order_cust, li.l_orderkey == order_cust.o_orderkey)
        rows = rows.select(month_label(F.col("o_orderdate")).alias("month"), *STAR_COLUMNS).hint("rebalance", F.col("month"))
    else:
        rows = li.join(order_cust, li.l_orderkey == order_cust.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    return rows.select(*STAR_COLUMNS)


def order_columns(rows: DataFrame) -> DataFrame:
    """The 25-column orders table of ``star_rows``, already in ``ORDERS_SCHEMA`` types."""
    total = money(F.col("l_extendedprice"))
    discount = round_money(total * rate(F.col("l_discount"), 4, 2))
    tax = round_money(total * rate(F.col("l_tax"), 4, 2))
    return rows.select(
        line_order_id().alias("order_id"),
        _s("o_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lit("c"), _s("o_custkey"), F.lit("@example.com")).alias("customer_email"),
        F.lpad(_s("o_custkey"), 10, "0").alias("customer_phone"),
        F.col("o_orderdate").alias("order_date"),
        _s("l_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("product_category"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        money(F.col("p_retailprice")).alias("unit_price"),
        total.alias("total_amount"),
        discount.alias("discount_amount"),
        tax.alias("tax_amount"),
        money(total - discount + tax).alias("final_amount"),
        F.concat(F.lit("Address "), _s("o_custkey")).alias("shipping_address"),
        F.concat(F.lit("City "), (F.col("o_custkey") % 100).cast("string")).alias("shipping_city"),
        F.col("n_name").alias("shipping_state"),
        F.lpad((F.col("o_custkey") % 100000).cast("string"), 5, "0").alias("shipping_zip"),
        F.col("r_name").alias("shipping_country"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("l_suppkey").cast("bigint").alias("store_id"),
        (F.lit(100) + F.col("l_suppkey") % 900).cast("bigint").alias("sales_rep_id"),
        F.col("p_promotion").alias("promotion_code"),
    )


def orders_from_star(spark: SparkSession, sf_dir: str, by_month: bool = False) -> DataFrame:
    """The 25-column orders table over the star tables; with ``by_month`` rows are gathered by month before the columns that follow from others are written out."""
    return order_columns(star_rows(spark, sf_dir, by_month))
