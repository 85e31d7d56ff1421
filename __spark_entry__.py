"""

``queries()`` runs each named query on the orders table built from the star
schema in ``sf_dir``; ``oracle_sql()`` gives the same result as DuckDB SQL
over the raw tables (an independent implementation of the fixture view and
of every operator).
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from importlib.util import find_spec

_ROOT = os.path.dirname(os.path.abspath(__file__))
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from ordersight.functions import hashing as H  # noqa: E402
from ordersight.plans import registry as R  # noqa: E402
from ordersight.schema import COLUMN_NAMES, MONEY_COLUMNS, present  # noqa: E402
from ordersight.sources import synth as S  # noqa: E402
from ordersight.sources.star import orders_from_star  # noqa: E402

# The training-data package is optional: without it the other queries stand alone.
# Only its absence is passed over; an operator that cannot be imported fails here.
_llm = _pipeline = None
if find_spec("ordersight.llm") is not None and find_spec("ordersight.llm.queries") is not None:
    from ordersight.llm import queries as _llm
    if find_spec("corpus_pipeline") is not None:
        import corpus_pipeline as _pipeline

SMOKE_DIR = "/root/testdata/sf0.001"


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: orders by status over the sf0.001 tables."""
    return present(R.ORDER_QUERIES["orders_by_status"](orders_from_star(spark, SMOKE_DIR)))


def _order_query(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(fn(orders_from_star(spark, sf_dir)))


def _table_query(fn) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: present(fn(spark, sf_dir))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    out = {name: _order_query(fn) for name, fn in R.ORDER_QUERIES.items()}
    out.update({name: _table_query(fn) for name, fn in R.TABLE_QUERIES.items()})
    if _llm is not None:
        out.update(_llm.QUERIES)
    if _pipeline is not None:
        out["pipeline"] = _pipeline.run
    return out


# ---------------------------------------------------------------------------
# Oracle SQL (DuckDB)

_LINE_KEY = (
    "concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
    "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d'))"
)

_WIDE = f"""
star AS (
  SELECT
    {_LINE_KEY} AS order_id,
    CAST(o_custkey AS VARCHAR) AS customer_id,
    c_name AS customer_name,
    'c' || CAST(c_custkey AS VARCHAR) || '@example.com' AS customer_email,
    lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS customer_phone,
    CAST(o_orderdate AS DATE) AS order_date,
    CAST(l_partkey AS VARCHAR) AS product_id,
    p_name AS product_name,
    p_type AS product_category,
    CAST(l_quantity AS BIGINT) AS quantity,
    CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS total_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS discount_amount,
    CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS tax_amount,
    'Address ' || CAST(c_custkey AS VARCHAR) AS shipping_address,
    'City ' || CAST(c_custkey % 100 AS VARCHAR) AS shipping_city,
    n_name AS shipping_state,
    lpad(CAST(c_custkey % 100000 AS VARCHAR), 5, '0') AS shipping_zip,
    r_name AS shipping_country,
    o_orderstatus AS order_status,
    o_orderpriority AS payment_method,
    CAST(l_suppkey AS BIGINT) AS store_id,
    CAST(100 + l_suppkey % 900 AS BIGINT) AS sales_rep_id,
    CASE WHEN p_size % 10 < 3 THEN p_brand END AS promotion_code
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
),
wide AS (
  SELECT order_id, customer_id, customer_name, customer_email, customer_phone, order_date,
         product_id, product_name, product_category, quantity, unit_price, total_amount,
         discount_amount, tax_amount,
         CAST(total_amount - discount_amount + tax_amount AS DECIMAL(18,2)) AS final_amount,
         shipping_address, shipping_city, shipping_state, shipping_zip, shipping_country,
         order_status, payment_method, store_id, sales_rep_id, promotion_code
  FROM star
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join((_WIDE,) + ctes) + "\n"


def _present_col(name: str) -> str:
    if name in MONEY_COLUMNS:
        return f"CAST({name} AS DOUBLE) AS {name}"
    if name == "order_date":
        return "strftime(order_date, '%Y-%m-%d') AS order_date"
    return name


def _present(cols=COLUMN_NAMES) -> str:
    return ", ".join(_present_col(c) for c in cols)


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


_P_DATE = f"order_date BETWEEN DATE '{R.DATE_RANGE[0]}' AND DATE '{R.DATE_RANGE[1]}'"
_P_CAT = f"product_category IN {_in(R.CATEGORIES)}"
_P_STATUS = f"order_status IN {_in(R.STATUSES)}"
_P_PAY = f"payment_method IN {_in(R.PAYMENTS)}"
_P_AMOUNT = f"final_amount BETWEEN {R.AMOUNT_RANGE[0]} AND {R.AMOUNT_RANGE[1]}"
_P_ALL = " AND ".join([_P_DATE, _P_CAT, _P_STATUS, _P_PAY, _P_AMOUNT])
_REVENUE = "CAST(coalesce(sum(final_amount), 0) AS DOUBLE)"
_KPIS = (
    "count(*) AS total_orders, "
    f"{_REVENUE} AS total_revenue, "
    "CAST(sum(final_amount) AS DOUBLE) / count(final_amount) AS avg_order_value, "
    "count(DISTINCT customer_id) AS unique_customers"
)


def _dollars(cents: str, thousands: bool) -> str:
    whole = f"abs({cents}) // 100"
    whole = f"format('{{:,}}', {whole})" if thousands else f"CAST({whole} AS VARCHAR)"
    return (
        f"'$' || CASE WHEN {cents} < 0 THEN '-' ELSE '' END || {whole} || '.' || "
        f"lpad(CAST(abs({cents}) % 100 AS VARCHAR), 2, '0')"
    )


def _kpi_formatted() -> str:
    k = (
        "k AS (SELECT count(*) AS n, CAST(coalesce(sum(final_amount), 0) * 100 AS BIGINT) AS cents, "
        "count(final_amount) AS n_amount, count(DISTINCT customer_id) AS customers FROM wide)"
    )
    a = (
        "a AS (SELECT *, abs(cents) // greatest(n_amount, 1) AS q, "
        "2 * (abs(cents) - (abs(cents) // greatest(n_amount, 1)) * n_amount) AS r2 FROM k)"
    )
    b = (
        "b AS (SELECT *, CASE WHEN cents < 0 THEN -1 ELSE 1 END * "
        "(q + CASE WHEN r2 > n_amount OR (r2 = n_amount AND q % 2 = 1) THEN 1 ELSE 0 END) AS avg_cents FROM a)"
    )
    return _with(k, a, b) + (
        "SELECT format('{:,}', n) AS total_orders, "
        f"{_dollars('cents', True)} AS total_revenue, "
        f"CASE WHEN n_amount > 0 THEN {_dollars('avg_cents', False)} END AS avg_order_value, "
        "format('{:,}', customers) AS unique_customers FROM b"
    )


def _histogram(bins: int = 50) -> str:
    v = "v AS (SELECT CAST(final_amount * 100 AS BIGINT) AS c FROM wide WHERE final_amount IS NOT NULL)"
    b = "b AS (SELECT min(c) AS lo, max(c) AS hi FROM v)"
    cnt = (
        "cnt AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE "
        f"least(CAST(floor(CAST((v.c - b.lo) * {bins} AS DOUBLE) / CAST(b.hi - b.lo AS DOUBLE)) AS BIGINT), {bins - 1}) "
        "END AS BIGINT) AS bucket, count(*) AS n FROM v CROSS JOIN b GROUP BY 1)"
    )
    grid = f"grid AS (SELECT CAST(range AS BIGINT) AS bucket FROM range({bins}))"

    def edge(i: str) -> str:
        return f"(CAST(b.lo AS DOUBLE) + CAST((b.hi - b.lo) * ({i}) AS DOUBLE) / {bins}) / 100"

    return _with(v, b, cnt, grid) + (
        f"SELECT g.bucket AS bucket, {edge('g.bucket')} AS bucket_low, {edge('g.bucket + 1')} AS bucket_high, "
        "coalesce(cnt.n, 0) AS n FROM grid g CROSS JOIN b LEFT JOIN cnt ON cnt.bucket = g.bucket "
        "WHERE b.lo IS NOT NULL"
    )


def _nice_histogram(bins: int = 50) -> str:
    v = "v AS (SELECT CAST(final_amount * 100 AS BIGINT) AS c FROM wide WHERE final_amount IS NOT NULL)"
    b = "b AS (SELECT min(c) AS lo, max(c) AS hi FROM v)"
    steps = "s AS (SELECT CAST(d * 10 ** k AS BIGINT) AS s FROM (SELECT unnest([1, 2, 5]) AS d), (SELECT unnest(range(17)) AS k))"
    down = lambda x, s: f"CAST(({x} - (({x} % {s}) + {s}) % {s}) // {s} AS BIGINT)"
    step = f"w AS (SELECT min(s) AS s FROM s, b WHERE {down('b.hi', 's.s')} - {down('b.lo', 's.s')} < {bins})"
    cnt = f"cnt AS (SELECT {down('v.c', 'w.s')} AS at, count(*) AS n FROM v, w GROUP BY 1)"
    ends = f"ends AS (SELECT {down('b.lo', 'w.s')} AS first, {down('b.hi', 'w.s')} AS last, w.s AS s FROM b, w WHERE b.lo IS NOT NULL)"
    grid = "grid AS (SELECT unnest(range(first, last + 1)) AS at, first, s FROM ends)"
    return _with(v, b, steps, step, cnt, ends, grid) + (
        "SELECT g.at - g.first AS bucket, CAST(g.at * g.s AS DOUBLE) / 100 AS bucket_low, "
        "CAST((g.at + 1) * g.s AS DOUBLE) / 100 AS bucket_high, coalesce(cnt.n, 0) AS n FROM grid g LEFT JOIN cnt ON cnt.at = g.at"
    )


def _co_purchase() -> str:
    return _with(
        "bought AS (SELECT DISTINCT customer_id AS c, product_id AS p FROM wide WHERE customer_id IS NOT NULL AND product_id IS NOT NULL)",
        "buyers AS (SELECT p, count(*) AS n FROM bought GROUP BY 1)",
        "pairs AS (SELECT x.p AS product, y.p AS partner, count(*) AS together FROM bought x JOIN bought y ON x.c = y.c AND x.p <> y.p "
        f"GROUP BY 1, 2 HAVING count(*) >= {R.MIN_TOGETHER})",
        "lifts AS (SELECT product, partner, together, "
        "CAST(together * (SELECT count(DISTINCT c) FROM bought) AS DOUBLE) / CAST(a.n * b.n AS DOUBLE) AS lift "
        "FROM pairs JOIN buyers a ON a.p = product JOIN buyers b ON b.p = partner)",
        "ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY product ORDER BY lift DESC, together DESC, partner) AS INTEGER) AS rank FROM lifts)",
    ) + f"SELECT product, partner, rank, together, lift FROM ranked WHERE rank <= {R.PARTNERS}"


def _seasonal() -> str:
    return _with(
        "monthly AS (SELECT date_trunc('month', order_date) AS m, count(*) AS n, coalesce(sum(final_amount), 0) AS amount "
        "FROM wide WHERE order_date IS NOT NULL GROUP BY 1)",
        "spine AS (SELECT unnest(generate_series(min(m), max(m), INTERVAL 1 MONTH)) AS m FROM monthly)",
        "dense AS (SELECT s.m, coalesce(n, 0) AS n, CAST(coalesce(amount, 0) AS DECIMAL(28,2)) AS amount FROM spine s LEFT JOIN monthly q ON q.m = s.m)",
        "w AS (SELECT m, n, amount, lag(amount, 12) OVER (ORDER BY m) AS before, "
        "CAST(sum(amount) OVER (PARTITION BY month(m)) AS DOUBLE) * count(*) OVER () AS season, "
        "CAST(sum(amount) OVER () AS DOUBLE) * count(*) OVER (PARTITION BY month(m)) AS average FROM dense)",
    ) + (
        "SELECT strftime(m, '%Y-%m') AS order_month, n AS order_count, CAST(amount AS DOUBLE) AS revenue, "
        "CAST(before AS DOUBLE) AS last_year, CASE WHEN before <> 0 THEN CAST(amount - before AS DOUBLE) / CAST(before AS DOUBLE) END AS change, "
        "CASE WHEN average <> 0 THEN season / average END AS seasonal_index FROM w"
    )


def _geo() -> str:
    return _with(
        "g AS (SELECT shipping_country, shipping_state, grouping(shipping_country, shipping_state) AS gid, count(*) AS order_count, "
        "count(DISTINCT customer_id) AS customers, coalesce(sum(final_amount), 0) AS amount FROM wide "
        "GROUP BY ROLLUP (shipping_country, shipping_state))",
    ) + (
        "SELECT CASE g.gid WHEN 0 THEN 'state' WHEN 1 THEN 'country' ELSE 'total' END AS level, g.shipping_country, g.shipping_state, "
        "g.order_count, g.customers, CAST(g.amount AS DOUBLE) AS revenue, "
        "CASE WHEN p.amount <> 0 THEN CAST(g.amount AS DOUBLE) / CAST(p.amount AS DOUBLE) END AS share_of_parent "
        "FROM g LEFT JOIN g p ON (g.gid = 0 AND p.gid = 1 AND p.shipping_country IS NOT DISTINCT FROM g.shipping_country) OR (g.gid = 1 AND p.gid = 3)"
    )


def _value_bands() -> str:
    return _with(
        "c AS (SELECT customer_id, count(*) AS order_count, coalesce(sum(final_amount), 0) AS v, count(final_amount) AS n, "
        "min(order_date) AS f, max(order_date) AS l FROM wide WHERE customer_id IS NOT NULL GROUP BY 1)",
    ) + (
        "SELECT customer_id, order_count, CAST(v AS DOUBLE) AS lifetime_value, CASE WHEN n > 0 THEN CAST(v AS DOUBLE) / n END AS avg_order_value, "
        "strftime(f, '%Y-%m-%d') AS first_order, strftime(l, '%Y-%m-%d') AS last_order, "
        f"row_number() OVER w AS value_rank, ntile({R.VALUE_BANDS}) OVER w AS value_band FROM c WINDOW w AS (ORDER BY v DESC, customer_id)"
    )


def _lake() -> str:
    first, last = R.LAKE_MONTHS
    redone = f"strftime(order_date, '%Y-%m') BETWEEN '{R.RERUN_MONTHS[0]}' AND '{R.RERUN_MONTHS[1]}'"
    return _with() + (
        f"SELECT strftime(order_date, '%Y-%m') AS order_month, CASE WHEN {redone} THEN order_status ELSE '?' END AS order_status, "
        "count(*) AS order_count, CAST(sum(final_amount) AS DOUBLE) AS revenue FROM wide "
        f"WHERE strftime(order_date, '%Y-%m') BETWEEN '{first}' AND '{last}' GROUP BY 1, 2"
    )


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _pick(values, w: str) -> str:
    return f"{_list(values)}[({w}) % {len(values)} + 1]"


def _synth_sql(profile: str, seed: int = 42) -> str:
    p = S.PROFILES[profile]

    def h(stream: str, key: str = "k") -> str:
        return f"md5('{seed}|{stream}|' || {key})"

    def w(word: str) -> str:
        source, start, step = S.DRAWS[word]
        a, c = H.jump(step)
        half = f"CAST(('0x' || substr({source[1:]}, {13 * start + 1}, 13)) AS BIGINT)"
        return f"((({half} % {H.MODULUS}) * {a} + {c}) % {H.MODULUS})"

    def uuid(col: str) -> str:
        return (
            f"substr({col}, 1, 8) || '-' || substr({col}, 9, 4) || '-' || '4' || substr({col}, 14, 3) || '-' || "
            f"substr({col}, 17, 4) || '-' || substr({col}, 21, 12)"
        )

    keys = f"keys AS (SELECT {_LINE_KEY} AS k FROM lineitem)"
    hashed = f"hashed AS (SELECT k, {h('order')} AS h_id, {h('customer')} AS h_cid, {h('product')} AS h_pid FROM keys)"
    cases = " ".join(f"WHEN '{c}' THEN {_list(p.products[c])}" for c in p.categories)
    lo, hi = p.price_cents
    words = (
        "words AS (SELECT *, "
        f"{_pick(p.categories, w('prod0'))} AS category, "
        f"1 + {w('a2')} % {p.max_quantity} AS quantity, "
        f"{lo} + {w('a3')} % {hi - lo + 1} AS price_cents, "
        f"{_pick(S.FIRST_NAMES, w('cust0'))} AS first, "
        f"{_pick(S.LAST_NAMES, w('cust1'))} AS last, "
        f"{_pick(S.CITIES, w('e1'))} AS city, "
        f"{_pick(S.US_STATES, w('e2'))} AS state, "
        f"lpad(CAST({w('e3')} % 100000 AS VARCHAR), 5, '0') AS zip, "
        + " || ".join(
            f"substr('{S.LETTERS}', CAST(({w('c3')} // {52 ** i}) % 52 + 1 AS INTEGER), 1)" for i in range(4)
        )
        + " AS letters FROM hashed)"
    )
    amounts = (
        "amounts AS (SELECT *, quantity * price_cents AS total_cents, "
        f"(quantity * price_cents * ({w('b0')} % 10001) * {p.max_discount_pct} + 500000) // 1000000 AS discount_cents, "
        f"(quantity * price_cents * {p.tax_pct} + 50) // 100 AS tax_cents FROM words)"
    )
    cw = lambda i: w(f"cust{i}")
    select = f"""
SELECT
  {uuid('h_id')} AS order_id,
  {uuid('h_cid')} AS customer_id,
  first || ' ' || last AS customer_name,
  lower(first) || '.' || lower(last) || '@' || {_pick(S.EMAIL_DOMAINS, cw(2))} AS customer_email,
  '(' || CAST(200 + {cw(3)} % 800 AS VARCHAR) || ') ' || lpad(CAST({cw(2)} % 1000 AS VARCHAR), 3, '0') || '-' ||
    lpad(CAST({cw(3)} % 10000 AS VARCHAR), 4, '0') AS customer_phone,
  strftime(DATE '{S.DEFAULT_END_DATE.isoformat()}' - CAST({w('c0')} % {p.days + 1} AS INTEGER), '%Y-%m-%d') AS order_date,
  {uuid('h_pid')} AS product_id,
  (CASE category {cases} END)[{w('prod1')} % len(CASE category {cases} END) + 1] AS product_name,
  category AS product_category,
  CAST(quantity AS BIGINT) AS quantity,
  price_cents / 100 AS unit_price,
  total_cents / 100 AS total_amount,
  discount_cents / 100 AS discount_amount,
  tax_cents / 100 AS tax_amount,
  (total_cents - discount_cents + tax_cents) / 100 AS final_amount,
  CAST(1 + {w('d1')} % 9999 AS VARCHAR) || ' ' || {_pick(S.STREET_NAMES, w('d2'))} || ' ' ||
    {_pick(S.STREET_SUFFIXES, w('d3'))} || ', ' || city || ', ' || state || ' ' || zip AS shipping_address,
  city AS shipping_city,
  state AS shipping_state,
  zip AS shipping_zip,
  {_pick(S.COUNTRIES, w('e0'))} AS shipping_country,
  {_pick(p.statuses, w('b1'))} AS order_status,
  {_pick(p.payments, w('b2'))} AS payment_method,
  CAST({p.store_range[0]} + {w('c1')} % {p.store_range[1] - p.store_range[0] + 1} AS BIGINT) AS store_id,
  CAST({p.rep_range[0]} + {w('c2')} % {p.rep_range[1] - p.rep_range[0] + 1} AS BIGINT) AS sales_rep_id,
  CASE WHEN {w('b3')} % 100 < {p.promo_pct} THEN '{p.promo_prefix}' || letters END AS promotion_code
FROM amounts"""
    return "WITH " + ",\n".join([keys, hashed, words, amounts]) + select


def _csv_name() -> str:
    cases = " ".join(
        f"WHEN store_id % {len(R.CSV_NAMES) + 1} = {i} THEN " + ("NULL" if n is None else f"'{n}'") for i, n in enumerate(R.CSV_NAMES)
    )
    return f"CASE {cases} ELSE customer_name END"


def _price_components_sql() -> str:
    total = "CAST(round(CAST(CAST(l_quantity AS BIGINT) AS DECIMAL(20,0)) * CAST(p_retailprice AS DECIMAL(18,2)), 2) AS DECIMAL(18,2))"
    return f"""
WITH base AS (
  SELECT {_LINE_KEY} AS order_id, CAST(l_quantity AS BIGINT) AS quantity,
         CAST(p_retailprice AS DECIMAL(18,2)) AS unit_price, {total} AS total_amount,
         CAST(l_discount AS DECIMAL(6,4)) AS rate
  FROM lineitem JOIN part ON l_partkey = p_partkey
), amounts AS (
  SELECT *, CAST(round(total_amount * rate, 2) AS DECIMAL(18,2)) AS discount_amount,
         CAST(round(total_amount * CAST(0.08 AS DECIMAL(6,4)), 2) AS DECIMAL(18,2)) AS tax_amount
  FROM base
)
SELECT order_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, CAST(total_amount AS DOUBLE) AS total_amount,
       CAST(discount_amount AS DOUBLE) AS discount_amount, CAST(tax_amount AS DOUBLE) AS tax_amount,
       CAST(CAST(total_amount - discount_amount + tax_amount AS DECIMAL(18,2)) AS DOUBLE) AS final_amount
FROM amounts"""


def oracle_sql() -> dict[str, str]:
    out = _orders_oracle_sql()
    if _llm is not None:
        out.update(_llm.ORACLE_SQL)
    if _pipeline is not None and _pipeline.ORACLE_SQL is not None:
        out["pipeline"] = _pipeline.ORACLE_SQL
    return out


def _orders_oracle_sql() -> dict[str, str]:
    W = _with()
    ten = COLUMN_NAMES[:10]
    by = lambda key: (
        f"SELECT {key}, count(*) AS order_count, CAST(sum(final_amount) AS DOUBLE) AS total_revenue "
        f"FROM wide GROUP BY {key}"
    )
    out = {
        "orders_by_status": W + by("order_status"),
        "stream_orders_by_status": W + by("order_status"),
        "category_revenue": W + by("product_category"),
        "monthly_trend": W
        + "SELECT strftime(order_date, '%Y-%m') AS order_month, count(*) AS order_count, "
        "CAST(sum(final_amount) AS DOUBLE) AS total_revenue FROM wide GROUP BY 1",
        "payment_distribution": W
        + "SELECT payment_method, count(*) AS order_count, "
        "CAST(sum(final_amount) AS DOUBLE) / count(final_amount) AS avg_order_value FROM wide GROUP BY 1",
        "top_states": W
        + "SELECT shipping_state, count(*) AS order_count FROM wide GROUP BY 1 "
        "ORDER BY order_count DESC, shipping_state ASC NULLS LAST LIMIT 20",
        "status_counts": W + 'SELECT order_status, count(*) AS "count" FROM wide GROUP BY 1',
        "category_counts": W + 'SELECT product_category, count(*) AS "count" FROM wide GROUP BY 1',
        "overview": W + f"SELECT count(*) AS total_rows, {len(COLUMN_NAMES)} AS total_columns FROM wide",
        "kpis": W + f"SELECT {_KPIS} FROM wide",
        "kpi_formatted": _kpi_formatted(),
        "status_share": W
        + "SELECT order_status, count(*) AS n, CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE) AS share "
        "FROM wide WHERE order_status IS NOT NULL GROUP BY 1",
        "payment_counts": W
        + "SELECT payment_method, count(*) AS n FROM wide WHERE payment_method IS NOT NULL GROUP BY 1",
        "category_revenue_chart": W
        + f"SELECT product_category, {_REVENUE} AS revenue FROM wide WHERE product_category IS NOT NULL GROUP BY 1",
        "top_products": W
        + f"SELECT product_name, {_REVENUE} AS revenue FROM wide WHERE product_name IS NOT NULL GROUP BY 1 "
        "ORDER BY coalesce(sum(final_amount), 0) DESC, product_name ASC NULLS LAST LIMIT 10",
        "amount_histogram": _histogram(),
        "amount_histogram_nice": _nice_histogram(),
        "co_purchase_top": _co_purchase(),
        "seasonal_trend": _seasonal(),
        "geo_rollup": _geo(),
        "customer_value_bands": _value_bands(),
        "first_50000": W + f"SELECT {_present()} FROM wide ORDER BY order_id LIMIT {R.FIRST_ROWS}",
        "verified_write": W + "SELECT order_status, count(*) AS n_rows, (SELECT count(*) FROM wide) AS verified_rows FROM wide GROUP BY 1",
        "export_lake": _lake(),
        "daily_trend": W
        + f"SELECT strftime(order_date, '%Y-%m-%d') AS date, count(order_id) AS order_count, {_REVENUE} AS revenue "
        "FROM wide WHERE order_date IS NOT NULL GROUP BY order_date",
        "top_states_orders": W
        + f"SELECT shipping_state, count(order_id) AS order_count, {_REVENUE} AS revenue FROM wide "
        "WHERE shipping_state IS NOT NULL GROUP BY 1 ORDER BY order_count DESC, shipping_state ASC NULLS LAST LIMIT 15",
        "top_states_revenue": W
        + f"SELECT shipping_state, {_REVENUE} AS revenue FROM wide WHERE shipping_state IS NOT NULL GROUP BY 1 "
        "ORDER BY coalesce(sum(final_amount), 0) DESC, shipping_state ASC NULLS LAST LIMIT 15",
        "scan_orders": W
        + f"SELECT {_present()} FROM (SELECT * REPLACE (CASE WHEN store_id % {R.NAN_EVERY} = 0 THEN NULL ELSE tax_amount END "
        "AS tax_amount) FROM wide)",
        "first_rows": W + f"SELECT {_present()} FROM wide ORDER BY order_id LIMIT {R.SAMPLE_ROWS}",
        "project_columns": W + f"SELECT {_present(R.PROJECTION)} FROM wide",
        "filter_options": W
        + "SELECT 'category' AS picker, product_category AS value FROM wide WHERE product_category IS NOT NULL "
        "UNION SELECT 'status', order_status FROM wide WHERE order_status IS NOT NULL "
        "UNION SELECT 'payment', payment_method FROM wide WHERE payment_method IS NOT NULL",
        "filter_bounds": W
        + "SELECT strftime(min(order_date), '%Y-%m-%d') AS min_date, strftime(max(order_date), '%Y-%m-%d') AS max_date, "
        "CAST(min(final_amount) AS DOUBLE) AS min_amount, CAST(max(final_amount) AS DOUBLE) AS max_amount, "
        "count(order_date) AS n_dates FROM wide",
        "filter_date": W + f"SELECT {_present()} FROM wide WHERE {_P_DATE}",
        "filter_category": W + f"SELECT {_present()} FROM wide WHERE {_P_CAT}",
        "filter_status": W + f"SELECT {_present()} FROM wide WHERE {_P_STATUS}",
        "filter_payment": W + f"SELECT {_present()} FROM wide WHERE {_P_PAY}",
        "filter_amount": W + f"SELECT {_present()} FROM wide WHERE {_P_AMOUNT}",
        "filter_all": W + f"SELECT {_present()} FROM wide WHERE {_P_ALL}",
        "filter_limit": W
        + f"SELECT {_present()} FROM wide WHERE {_P_ALL} ORDER BY order_id LIMIT {R.DASHBOARD_ROW_LIMIT}",
        "table_view": W
        + f"SELECT {_present(ten)} FROM wide WHERE {_P_ALL}",
        "single_line_address": W
        + "SELECT order_id, shipping_address || ', ' || shipping_city || ', ' || shipping_state AS address FROM wide",
        "dashboard_kpis": W + f"SELECT {_KPIS} FROM wide WHERE {_P_ALL}",
        "dashboard_category": W
        + f"SELECT product_category, {_REVENUE} AS revenue FROM wide "
        f"WHERE {_P_ALL} AND product_category IS NOT NULL GROUP BY 1",
        "price_components": _price_components_sql(),
        "synth_orders": _synth_sql("full"),
        "synth_orders_small": _synth_sql("small"),
        "scan_union": W
        + f"SELECT {_present()} FROM wide UNION ALL SELECT {_present()} FROM wide WHERE order_status = '{R.UNION_STATUS}'",
        "export_sample": W + f"SELECT {_present()} FROM wide ORDER BY order_id LIMIT {R.SAMPLE_ROWS}",
        "export_csv": W
        + f"SELECT {_present(ten)} FROM (SELECT * REPLACE ({_csv_name()} AS customer_name) FROM wide) WHERE {_P_ALL}",
        "append_batches": W + f"SELECT {_present()} FROM wide",
        "file_inventory": W + "SELECT order_status AS folder, count(*) AS n_rows FROM wide GROUP BY 1",
        "file_summary": W
        + "SELECT coalesce(order_status, 'TOTAL') AS folder, count(*) AS n_rows FROM wide GROUP BY GROUPING SETS ((order_status), ())",
    }
    nulls = ", ".join(f"CASE WHEN store_id % {n} <> 0 THEN {c} END AS {c}" for c, n in R.NULL_EVERY.items())
    holed = _WIDE.replace("\nwide AS (", "\nwhole AS (", 1) + f",\nwide AS (SELECT * REPLACE ({nulls}) FROM whole)"
    out.update({f"nulls_{name}": out[name].replace(_WIDE, holed, 1) for name in (*R.NULL_QUERIES, "customer_value_bands")})
    return out
