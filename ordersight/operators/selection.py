"""The first n rows of a large table, for any n, without a task that merges every task's first n.

The n-th smallest key is found by narrowing a key range: each pass over the key
column (alone, with the range pushed to the scan) counts it and draws an even
sample of at most SAMPLE keys, whose counts then bound the n-th key from both
sides. Rows under the range stay where they are, and only the rows inside it,
a few thousand or the ties of one key, are put in order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.operators.ranking import numbered

#: Keys of a pass's sample, each the one with the smallest hash in a slot of its own.
SAMPLE = 4096
#: A range of at most this many rows is put in order as it is.
SMALL = 10_000
#: How far, in standard deviations of the sample's rank, the two bounds lie from the wanted key.
SPREAD = 4.0
#: Further keys of the sample that are counted in each pass, evenly spaced.
GRID = 16


def _within(key: Column, low, high) -> Column:
    """low < key <= high; None is no bound."""
    out = key.isNotNull()
    if low is not None:
        out = out & (key > F.lit(low))
    if high is not None:
        out = out & (key <= F.lit(high))
    return out


def _look(keys: DataFrame) -> tuple[int, list]:
    """(row count, ascending sample of distinct keys)."""
    hashed = keys.select("key", F.xxhash64("key").alias("h"))
    slots = hashed.groupBy(F.pmod("h", F.lit(SAMPLE))).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("h", "key")).alias("least"))
    row = slots.agg(F.sum("n"), F.sort_array(F.collect_list("least.key"))).first()
    return row[0] or 0, row[1]


def boundary(df: DataFrame, n: int, key: str) -> tuple:
    """(low, high, missing, rows): where the ``n``-th smallest key of ``df`` lies, NULL keys apart.

    All rows with key <= low are among the first ``n``, and so are ``missing`` of the
    ``rows`` with low < key <= high; None is no bound. That range holds at most
    SMALL rows or one key, unless all keys are wanted (then missing = rows).
    """
    keys = df.select(F.col(f"`{key}`").alias("key"))
    low = high = None
    missing = n
    while True:
        here = keys.where(_within(F.col("key"), low, high))
        rows, sample = _look(here)
        if rows <= missing or rows <= SMALL or len(sample) == 1:
            return low, high, min(missing, rows), rows
        last = len(sample) - 1
        share = missing / rows
        slack = SPREAD * (len(sample) * share * (1 - share)) ** 0.5 + 1
        # Two keys that should enclose the wanted one, and some others in case ties mislead the sample.
        picks = {max(int(len(sample) * share - slack), 0), min(int(len(sample) * share + slack), last)}
        picks |= {last * i // GRID for i in range(GRID)}
        cuts = [sample[i] for i in sorted(picks)]
        counts = here.agg(F.count(F.lit(1)), *[F.count_if(F.col("key") <= F.lit(c)) for c in cuts]).first()[1:]
        for cut, upto in zip(cuts, counts):
            if upto >= missing:
                high = cut
                break
            low = cut
        missing -= max([c for c in counts if c < missing], default=0)


def _some(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` rows of ``df``, the first in ``key`` order; numbered across tasks."""
    number = "position"
    while number in df.columns:
        number += "_"
    return numbered(df, [key], number=number).where(F.col(number) <= n).drop(number)


def first_n(df: DataFrame, n: int, key: str = "order_id") -> DataFrame:
    """The first ``n`` rows of ``df`` in ``key`` order, NULL keys last; the result itself is not sorted.

    Of rows that tie at the end any may stay, but exactly ``n`` rows do (all, if there
    are fewer). Reads the key column a few times, so ``df`` should be a stored
    table or a scan; the search runs when this is called.
    """
    if n < 0:
        raise ValueError("row limit must be >= 0")
    if n == 0:
        return df.limit(0)
    name = F.col(f"`{key}`")
    low, high, missing, rows = boundary(df, n, key)
    inside = df.where(_within(name, low, high))
    if low is not None or high is not None or rows > missing:
        inside = inside if rows == missing else _some(inside, missing, key)
        return inside if low is None else df.where(_within(name, None, low)).unionByName(inside)
    nulls = df.where(name.isNull())
    return inside.unionByName(nulls if nulls.count() <= n - rows else _some(nulls, n - rows, key))
