"""Positions in a total order without a one-task window.

Rows are range-partitioned once by (group, order); each task numbers its own
sorted rows, and one small row per (task, group) carries how many rows of the
group lie in earlier tasks. A group that holds most rows, or rows that tie in
every key, spread over as many tasks as any other data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ordersight.session import scratch_path

#: ``monotonically_increasing_id`` is the task's number above this bit and the row's position below it.
_TASK_BIT = 33


def numbered(
    df: DataFrame,
    order: Sequence[str | tuple[str, str]],
    group: Sequence[str] = (),
    *,
    nulls_first: bool = False,
    number: str = "row_number",
    size: str | None = None,
) -> DataFrame:
    """``df`` with each row's position (from 1) in its group, and the group's ``size`` if named.

    ``order`` holds column names, or (name, "desc"). NULL order keys come last,
    or first on request; NULL group keys are one group. Rows that tie in every
    key get different positions. Two narrow passes: the rows are shuffled once
    and written to the shared folder, so positions survive a lost executor.
    """
    taken = {number, size} & set(df.columns)
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    keys = [k if isinstance(k, tuple) else (k, "asc") for k in order]
    if any(way not in ("asc", "desc") for _, way in keys):
        raise ValueError("order is a column name or (name, 'asc' or 'desc')")

    def plain(name: str) -> Column:
        return F.col(f"`{name}`")

    def directed(name: str, way: str) -> Column:
        return getattr(F.col(name), f"{way}_nulls_{'first' if nulls_first else 'last'}")()

    groups = [f"g{i}" for i in range(len(group))]
    rows = df.select(
        F.struct(*[plain(c) for c in df.columns]).alias("row"),
        *[plain(c).alias(g) for c, g in zip(group, groups)],
        *[plain(c).alias(f"o{i}") for i, (c, _) in enumerate(keys)],
        F.monotonically_increasing_id().alias("tie"),
    )
    total_order = [F.asc_nulls_first(g) for g in groups] + [directed(f"o{i}", way) for i, (_, way) in enumerate(keys)] + [F.asc("tie")]
    dealt = rows.repartitionByRange(*total_order).sortWithinPartitions(*total_order)
    dealt = _kept(dealt.select("row", *groups, F.monotonically_increasing_id().alias("at")), "numbered-rows")

    task = F.shiftright("at", _TASK_BIT)
    runs = dealt.groupBy(task.alias("task"), *groups).agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    of_group = Window.partitionBy(*groups)
    earlier = F.sum("n").over(of_group.orderBy("task").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(
        F.col("task").alias("b_task"),
        *[F.col(g).alias(f"b_{g}") for g in groups],
        (F.coalesce(earlier, F.lit(0)) - F.col("first") + 1).alias("shift"),
        F.sum("n").over(of_group).alias("b_size"),
    )
    # At most tasks + groups rows; stored, so that the planner knows the size when it picks the join.
    runs = _kept(runs, "numbered-runs")

    same = task == F.col("b_task")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"b_{g}"))
    out = [F.col("row")[c].alias(c) for c in df.columns] + [(F.col("at") + F.col("shift")).alias(number)]
    if size is not None:
        out.append(F.col("b_size").alias(size))
    return dealt.join(runs, same).select(*out)


def band(number: Column, size: Column, bands: int) -> Column:
    """The 1-based band of a position when ``size`` rows go to ``bands`` bands of equal size; the first bands take the rest (``ntile``)."""
    small = F.floor(size / bands)
    wide = F.pmod(size, F.lit(bands))
    in_wide = wide * (small + 1)
    later = wide + F.floor((number - 1 - in_wide) / F.greatest(small, F.lit(1))) + 1
    return F.when(number <= in_wide, F.floor((number - 1) / (small + 1)) + 1).otherwise(later).cast("long")


def _kept(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
