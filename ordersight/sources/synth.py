"""Synthetic orders as a Spark job.

``synthesize(keys)`` turns any DataFrame of row keys into 25-column orders;
``generate_orders(spark, n)`` feeds it ``spark.range(n)``. Each cell is a pure
function of (seed, column stream, key), so the output is identical for any
partitioning and survives task retries unchanged. One stage, no shuffle.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.functions.hashing import MODULUS, digest, draw, half, pick, uuid_text
from ordersight.functions.money import from_cents

# ---------------------------------------------------------------------------
# Domains that must equal the reference generator's.
# Full profile.
FULL_CATEGORIES = (
    "Electronics", "Clothing", "Home & Garden", "Sports", "Books",
    "Beauty", "Toys", "Automotive", "Health", "Food & Beverages",
)
FULL_PRODUCTS = {
    "Electronics": ("Smartphone", "Laptop", "Tablet", "Headphones", "Smart Watch", "Camera", "Gaming Console"),
    "Clothing": ("T-Shirt", "Jeans", "Dress", "Sneakers", "Jacket", "Sweater", "Pants"),
    "Home & Garden": ("Furniture", "Kitchen Appliances", "Garden Tools", "Lighting", "Bedding", "Decor"),
    "Sports": ("Running Shoes", "Fitness Equipment", "Sports Apparel", "Outdoor Gear", "Bicycle"),
    "Books": ("Fiction Novel", "Non-Fiction", "Textbook", "Cookbook", "Biography", "Self-Help"),
    "Beauty": ("Skincare", "Makeup", "Hair Care", "Fragrance", "Nail Care"),
    "Toys": ("Action Figures", "Board Games", "Educational Toys", "Dolls", "Building Blocks"),
    "Automotive": ("Car Parts", "Car Accessories", "Motor Oil", "Tires", "Car Electronics"),
    "Health": ("Vitamins", "Medical Supplies", "Fitness Supplements", "Personal Care"),
    "Food & Beverages": ("Snacks", "Beverages", "Canned Goods", "Fresh Produce", "Frozen Foods"),
}
FULL_STATUSES = ("Pending", "Processing", "Shipped", "Delivered", "Cancelled")
FULL_PAYMENTS = ("Credit Card", "Debit Card", "PayPal", "Bank Transfer", "Cash")
# Small profile.
SMALL_CATEGORIES = ("Electronics", "Clothing", "Home & Garden", "Sports", "Books")
SMALL_PRODUCTS = {
    "Electronics": ("Smartphone", "Laptop", "Tablet"),
    "Clothing": ("T-Shirt", "Jeans", "Dress"),
    "Home & Garden": ("Furniture", "Kitchen Appliances"),
    "Sports": ("Running Shoes", "Fitness Equipment"),
    "Books": ("Fiction Novel", "Non-Fiction"),
}
SMALL_STATUSES = ("Pending", "Processing", "Shipped", "Delivered")
SMALL_PAYMENTS = ("Credit Card", "Debit Card", "PayPal")
# ---------------------------------------------------------------------------

# Our own small pools for people and places (not meant to match anything).
FIRST_NAMES = (
    "Ada", "Ben", "Cora", "Dev", "Elena", "Felix", "Grace", "Hugo", "Ines", "Jonas",
    "Kira", "Liam", "Maya", "Noah", "Olga", "Pablo", "Quinn", "Rosa", "Sam", "Tara",
    "Umar", "Vera", "Wes", "Xena", "Yuki", "Zane",
)
LAST_NAMES = (
    "Adams", "Baker", "Chen", "Diaz", "Evans", "Fischer", "Garcia", "Hill", "Ito", "Jones",
    "Khan", "Lopez", "Moore", "Nguyen", "Owens", "Patel", "Reed", "Smith", "Turner", "Walsh",
)
EMAIL_DOMAINS = ("example.com", "example.org", "example.net", "mail.example")
STREET_NAMES = (
    "Oak", "Maple", "Cedar", "Pine", "Elm", "Birch", "Lake", "Hill", "River", "Park",
    "Sunset", "Mill", "Church", "Spring", "Forest", "Meadow",
)
STREET_SUFFIXES = ("St", "Ave", "Rd", "Blvd", "Ln", "Dr", "Ct", "Way")
CITIES = (
    "Springfield", "Riverton", "Lakeside", "Fairview", "Georgetown", "Madison", "Franklin",
    "Clinton", "Greenville", "Bristol", "Salem", "Oakland", "Ashland", "Dover", "Milton",
    "Newport", "Oxford", "Burlington", "Jackson", "Kingston",
)
US_STATES = (
    "Alabama", "Alaska", "Arizona", "Arkansas", "California", "Colorado", "Connecticut",
    "Delaware", "Florida", "Georgia", "Hawaii", "Idaho", "Illinois", "Indiana", "Iowa",
    "Kansas", "Kentucky", "Louisiana", "Maine", "Maryland", "Massachusetts", "Michigan",
    "Minnesota", "Mississippi", "Missouri", "Montana", "Nebraska", "Nevada", "New Hampshire",
    "New Jersey", "New Mexico", "New York", "North Carolina", "North Dakota", "Ohio",
    "Oklahoma", "Oregon", "Pennsylvania", "Rhode Island", "South Carolina", "South Dakota",
    "Tennessee", "Texas", "Utah", "Vermont", "Virginia", "Washington", "West Virginia",
    "Wisconsin", "Wyoming",
)
COUNTRIES = (
    "Argentina", "Australia", "Austria", "Belgium", "Brazil", "Canada", "Chile", "Denmark",
    "Egypt", "Finland", "France", "Germany", "Greece", "India", "Ireland", "Italy", "Japan",
    "Kenya", "Mexico", "Netherlands", "New Zealand", "Norway", "Peru", "Poland", "Portugal",
    "Singapore", "Spain", "Sweden", "Switzerland", "United States",
)
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class Profile:
    categories: tuple[str, ...]
    products: dict[str, tuple[str, ...]]
    statuses: tuple[str, ...]
    payments: tuple[str, ...]
    days: int  # order_date in [end_date - days, end_date]
    max_quantity: int
    price_cents: tuple[int, int]  # inclusive
    max_discount_pct: int  # discount ~ U(0, pct% of total)
    tax_pct: int
    store_range: tuple[int, int]
    rep_range: tuple[int, int]
    promo_prefix: str
    promo_pct: int  # share of rows with a promotion code


PROFILES = {
    "full": Profile(
        FULL_CATEGORIES, FULL_PRODUCTS, FULL_STATUSES, FULL_PAYMENTS,
        days=730, max_quantity=10, price_cents=(500, 50000), max_discount_pct=20, tax_pct=8,
        store_range=(1000, 9999), rep_range=(100, 999), promo_prefix="PROMO", promo_pct=30,
    ),
    "small": Profile(
        SMALL_CATEGORIES, SMALL_PRODUCTS, SMALL_STATUSES, SMALL_PAYMENTS,
        days=365, max_quantity=5, price_cents=(1000, 20000), max_discount_pct=10, tax_pct=8,
        store_range=(1000, 1999), rep_range=(100, 199), promo_prefix="TEST", promo_pct=20,
    ),
}

DEFAULT_END_DATE = _dt.date(2025, 6, 30)


#: Word -> (digest, start, step): the draws a row takes.
DRAWS = {
    f"{stream}{i}": (source, i % 2, at * 2 + i // 2 + 1)
    for source, streams in (("_h_id", "abcde"), ("_h_cid", ("cust",)), ("_h_pid", ("prod",)))
    for at, stream in enumerate(streams)
    for i in range(4)
}


def _span(w: Column, lo: int, hi: int) -> Column:
    return (F.lit(lo) + w % (hi - lo + 1)).cast("bigint")


def _digits(w: Column, n: int) -> Column:
    return F.lpad((w % (10**n)).cast("string"), n, "0")


def synthesize(
    keys: DataFrame,
    key_col: str = "key",
    *,
    seed: int = 42,
    profile: str = "full",
    end_date: _dt.date = DEFAULT_END_DATE,
    n_customers: int | None = None,
    n_products: int | None = None,
) -> DataFrame:
    """One synthetic order per row of ``keys`` (keys must be unique).

    ``n_customers`` / ``n_products`` make ids repeat (each customer or product
    has stable attributes); by default every row gets fresh ids, as in the
    reference generator.

    The work is staged in projections (digests, starts, draws, values, text).
    Each stays small enough for the JIT to compile; a single 25-column
    projection of nested hash expressions does not, and runs several times
    slower.
    """
    p = PROFILES[profile]
    key = F.col(key_col).cast("string")

    # 1. digests: one md5 each for the order, its customer and its product
    # (pool ids are drawn from 52 bits, so every id of billions is reached).
    with_key = keys.select(key.alias("_k"))
    cust_key = (half(digest(seed, "d", F.col("_k")), 0) % n_customers).cast("string") if n_customers else F.col("_k")
    prod_key = (half(digest(seed, "a", F.col("_k")), 0) % n_products).cast("string") if n_products else F.col("_k")
    hashed = with_key.select(
        digest(seed, "order", F.col("_k")).alias("_h_id"),
        digest(seed, "customer", cust_key).alias("_h_cid"),
        digest(seed, "product", prod_key).alias("_h_pid"),
    )

    # 2. draws: every random word as a BIGINT column, from two starts a digest.
    ids = ["_h_id", "_h_cid", "_h_pid"]
    starts = hashed.select(*ids, *[(half(F.col(h), j) % MODULUS).alias(f"{h}_{j}") for h in ids for j in range(2)])
    words = starts.select(*ids, *[draw(F.col(f"{h}_{j}"), n).alias(name) for name, (h, j, n) in DRAWS.items()])
    w = {n: F.col(n) for n in DRAWS}

    # 3. values: picks, integers and amounts in cents.
    category = pick(p.categories, w["prod0"])
    names_by_category = F.create_map(
        *[x for c in p.categories for x in (F.lit(c), F.array(*[F.lit(n) for n in p.products[c]]))]
    )
    quantity = _span(w["a2"], 1, p.max_quantity)
    price_cents = _span(w["a3"], *p.price_cents)
    letters = F.concat(
        *[F.substring(F.lit(LETTERS), ((w["c3"] / F.lit(52**i)).cast("bigint") % 52 + 1).cast("int"), 1) for i in range(4)]
    )
    values = words.select(
        "*",
        category.alias("_category"),
        F.element_at(names_by_category, category).alias("_names"),
        quantity.alias("_quantity"),
        (quantity * price_cents).alias("_total_c"),
        price_cents.alias("_price_c"),
        pick(FIRST_NAMES, w["cust0"]).alias("_first"),
        pick(LAST_NAMES, w["cust1"]).alias("_last"),
        pick(US_STATES, w["e2"]).alias("_state"),
        pick(CITIES, w["e1"]).alias("_city"),
        _digits(w["e3"], 5).alias("_zip"),
        letters.alias("_letters"),
    )
    # Integer operands stay below 2^53, so floor of the double quotient is exact.
    discount_c = F.floor((F.col("_total_c") * (w["b0"] % 10001) * p.max_discount_pct + 500000) / F.lit(1000000))
    tax_c = F.floor((F.col("_total_c") * p.tax_pct + 50) / F.lit(100))
    amounts = values.select(
        "*",
        discount_c.cast("bigint").alias("_discount_c"),
        tax_c.cast("bigint").alias("_tax_c"),
    )

    # 4. text columns, then 5. the declared column order (two projections:
    # one would again exceed the JIT's method size limit).
    first, last, city, state, zip_code = (F.col(c) for c in ("_first", "_last", "_city", "_state", "_zip"))
    names = F.col("_names")
    text = amounts.select(
        "*",
        uuid_text(F.col("_h_id")).alias("_order_id"),
        uuid_text(F.col("_h_cid")).alias("_customer_id"),
        uuid_text(F.col("_h_pid")).alias("_product_id"),
        F.concat_ws(" ", first, last).alias("_customer_name"),
        F.concat(F.lower(first), F.lit("."), F.lower(last), F.lit("@"), pick(EMAIL_DOMAINS, w["cust2"])).alias(
            "_customer_email"
        ),
        F.concat(
            F.lit("("), (F.lit(200) + w["cust3"] % 800).cast("string"), F.lit(") "),
            _digits(w["cust2"], 3), F.lit("-"), _digits(w["cust3"], 4),
        ).alias("_customer_phone"),
        F.concat(
            (F.lit(1) + w["d1"] % 9999).cast("string"), F.lit(" "), pick(STREET_NAMES, w["d2"]), F.lit(" "),
            pick(STREET_SUFFIXES, w["d3"]), F.lit(", "), city, F.lit(", "), state, F.lit(" "), zip_code,
        ).alias("_shipping_address"),
    )
    return text.select(
        F.col("_order_id").alias("order_id"),
        F.col("_customer_id").alias("customer_id"),
        F.col("_customer_name").alias("customer_name"),
        F.col("_customer_email").alias("customer_email"),
        F.col("_customer_phone").alias("customer_phone"),
        F.date_sub(F.lit(end_date), (w["c0"] % (p.days + 1)).cast("int")).alias("order_date"),
        F.col("_product_id").alias("product_id"),
        F.element_at(names, (w["prod1"] % F.size(names) + 1).cast("int")).alias("product_name"),
        F.col("_category").alias("product_category"),
        F.col("_quantity").alias("quantity"),
        from_cents(F.col("_price_c")).alias("unit_price"),
        from_cents(F.col("_total_c")).alias("total_amount"),
        from_cents(F.col("_discount_c")).alias("discount_amount"),
        from_cents(F.col("_tax_c")).alias("tax_amount"),
        from_cents(F.col("_total_c") - F.col("_discount_c") + F.col("_tax_c")).alias("final_amount"),
        F.col("_shipping_address").alias("shipping_address"),
        city.alias("shipping_city"),
        state.alias("shipping_state"),
        zip_code.alias("shipping_zip"),
        pick(COUNTRIES, w["e0"]).alias("shipping_country"),
        pick(p.statuses, w["b1"]).alias("order_status"),
        pick(p.payments, w["b2"]).alias("payment_method"),
        _span(w["c1"], *p.store_range).alias("store_id"),
        _span(w["c2"], *p.rep_range).alias("sales_rep_id"),
        F.when(w["b3"] % 100 < p.promo_pct, F.concat(F.lit(p.promo_prefix), F.col("_letters"))).alias(
            "promotion_code"
        ),
    )


def generate_orders(
    spark: SparkSession,
    n: int,
    *,
    seed: int = 42,
    profile: str = "full",
    end_date: _dt.date = DEFAULT_END_DATE,
    partitions: int | None = None,
    n_customers: int | None = None,
    n_products: int | None = None,
) -> DataFrame:
    """``n`` synthetic orders keyed 0..n-1; ``partitions`` sets the task (and
    output file) count; the default is the cluster's parallelism."""
    keys = spark.range(0, n, numPartitions=partitions).select(F.col("id").cast("string").alias("key"))
    return synthesize(
        keys, seed=seed, profile=profile, end_date=end_date,
        n_customers=n_customers, n_products=n_products,
    )
