"""Composable order filters.

An ``OrderFilter`` compiles to ONE conjunctive predicate, applied in a single
``where`` so Catalyst pushes the date range and IN lists into the parquet scan.
Semantics follow SQL three-valued logic: NULL never passes an IN list or a
range, and an empty or absent selection means "no filter".
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.operators.ordering import ordered_limit
from ordersight.schema import MONEY

DateLike = _dt.date | str


def _as_date(d: DateLike) -> _dt.date:
    return d if isinstance(d, _dt.date) else _dt.date.fromisoformat(d)


@dataclass(frozen=True)
class OrderFilter:
    """Dashboard filter parameters; ``None`` (or empty) leaves a dimension open.

    ``date_range`` applies only when it holds exactly two dates (inclusive on
    the calendar date). ``amount_range`` is inclusive on ``final_amount``.
    ``row_limit`` keeps the first n matching rows in ``order_id`` order.
    """

    date_range: tuple[DateLike, ...] | None = None
    categories: tuple[str, ...] | None = None
    statuses: tuple[str, ...] | None = None
    payment_methods: tuple[str, ...] | None = None
    amount_range: tuple[float, float] | None = None
    row_limit: int | None = None


def date_predicate(lo: DateLike, hi: DateLike, column: str = "order_date") -> Column:
    return F.to_date(F.col(column)).between(F.lit(_as_date(lo)), F.lit(_as_date(hi)))


def in_predicate(column: str, values) -> Column:
    return F.col(column).isin(list(values))


_MOST = Decimal("9999999999999999.99")


def _edge(value: float | str | Decimal, rounding: str) -> Column:
    """A bound as a DECIMAL(18,2) literal: rounded into the range, which no two-digit amount notices."""
    exact = Decimal(str(value))
    if exact.is_infinite() or abs(exact) > _MOST:
        exact = _MOST.copy_sign(exact)
    return F.lit(exact.quantize(Decimal("0.01"), rounding)).cast(MONEY)


def amount_predicate(lo: float, hi: float, column: str = "final_amount") -> Column:
    """``lo <= column <= hi`` for a conformed amount, as decimals, so that it reaches the parquet scan.

    NaN bounds compare with nothing and raise.
    """
    if any(Decimal(str(v)).is_nan() for v in (lo, hi)):
        raise ValueError("amount bounds must be numbers")
    return F.col(column).between(_edge(lo, ROUND_CEILING), _edge(hi, ROUND_FLOOR))


def filter_predicate(filt: OrderFilter, columns: list[str] | tuple[str, ...]) -> Column | None:
    """The conjunction of every active filter whose column exists."""
    have = set(columns)
    preds: list[Column] = []
    if filt.date_range and len(filt.date_range) == 2 and "order_date" in have:
        preds.append(date_predicate(*filt.date_range))
    for column, values in (
        ("product_category", filt.categories),
        ("order_status", filt.statuses),
        ("payment_method", filt.payment_methods),
    ):
        if values and column in have:
            preds.append(in_predicate(column, values))
    if filt.amount_range and "final_amount" in have:
        preds.append(amount_predicate(*filt.amount_range))
    return reduce(and_, preds) if preds else None


def apply_filter(df: DataFrame, filt: OrderFilter) -> DataFrame:
    """All predicates, then the optional row limit."""
    pred = filter_predicate(filt, df.columns)
    out = df.where(pred) if pred is not None else df
    return ordered_limit(out, filt.row_limit)


def filter_bounds(df: DataFrame) -> DataFrame:
    """Slider bounds in one pass: date and amount min/max, non-null dates; a column that is absent has no bounds."""
    return df.agg(*bound_measures(df.columns))


def bound_measures(columns) -> list[Column]:
    """The aggregates behind the sliders whose columns exist; at least the row count, as ``n_rows``, if none does."""
    out = []
    if "order_date" in columns:
        out += [F.min("order_date").alias("min_date"), F.max("order_date").alias("max_date")]
    if "final_amount" in columns:
        out += [F.min("final_amount").alias("min_amount"), F.max("final_amount").alias("max_amount")]
    if "order_date" in columns:
        out.append(F.count("order_date").alias("n_dates"))
    return out or [F.count(F.lit(1)).alias("n_rows")]


PICKER_COLUMNS = (
    ("category", "product_category"),
    ("status", "order_status"),
    ("payment", "payment_method"),
)


def filter_options(df: DataFrame) -> DataFrame:
    """Distinct non-null values for each picker, as (picker, value) rows.

    One scan: each row is expanded into three tagged values, de-duplicated map
    side, then shuffled; only the few distinct values are sorted.
    """
    cols = [(tag, c) for tag, c in PICKER_COLUMNS if c in df.columns]
    tagged = F.explode(
        F.array(*[F.struct(F.lit(tag).alias("picker"), F.col(c).cast("string").alias("value")) for tag, c in cols])
    )
    return (
        df.select(tagged.alias("o"))
        .select("o.picker", "o.value")
        .where(F.col("value").isNotNull())
        .distinct()
        .orderBy("picker", "value")
    )
