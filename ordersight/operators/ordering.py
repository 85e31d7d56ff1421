"""Total orders for sorts and limits.

Every ordered result breaks ties on its key (ascending, NULLs last), so a
limit always returns the same rows whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.operators.selection import first_n

#: The most rows that one task merges from every other task.
DISPLAY_ROWS = 1_000


def _key_order(keys: Sequence[str]) -> list[Column]:
    return [F.asc_nulls_last(k) for k in keys]


def sort_by_measure(df: DataFrame, measure: str, keys: Sequence[str], descending: bool = True) -> DataFrame:
    m = F.desc_nulls_last(measure) if descending else F.asc_nulls_last(measure)
    return df.orderBy(m, *_key_order(keys))


def top_k(df: DataFrame, measure: str, keys: Sequence[str], k: int, descending: bool = True) -> DataFrame:
    """Top-k rows by a measure; planned as TakeOrderedAndProject (no full sort)."""
    return sort_by_measure(df, measure, keys, descending).limit(k)


def ordered_limit(df: DataFrame, n: int | None, key: str = "order_id") -> DataFrame:
    """First ``n`` rows in ``key`` order ("first n" made deterministic), sorted; ``None`` means no limit.

    Up to DISPLAY_ROWS rows this is one lazy plan, ``TakeOrderedAndProject``: each task
    keeps its first ``n`` in a bounded heap and one task merges them. For more rows
    the ``n``-th key is searched first (``first_n``, which runs when this is called and
    reads the key column a few times), so that no task merges tasks x ``n`` rows.
    """
    if n is None:
        return df
    if n < 0:
        raise ValueError("row limit must be >= 0")
    if n > DISPLAY_ROWS:
        df = first_n(df, n, key)
        return df.orderBy(F.asc_nulls_last(key))
    return df.orderBy(F.asc_nulls_last(key)).limit(n)
