"""One scan for many groupings.

``grouped_once`` aggregates a frame over several single-column grains in one
``GROUPING SETS`` pass and tags every output row with its grain. Because
``grouping_id()`` tells a rolled-up column from a real NULL key, NULL groups
survive intact. The aggregated result has one row per (grain, key) and is
checkpointed to the shared checkpoint folder, so the per-grain reports that
follow read a few hundred rows instead of rescanning the orders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.session import checkpoint_root


def grain_id(position: int, width: int) -> int:
    """``grouping_id()`` of the set that groups only column ``position``."""
    return (1 << width) - 1 - (1 << (width - 1 - position))


def grouped_once(
    df: DataFrame,
    grains: Sequence[str],
    measures: Sequence[Column],
    *,
    include_total: bool = False,
    materialize: bool = True,
) -> DataFrame:
    sets = [[g] for g in grains] + ([[]] if include_total else [])
    agg = df.groupingSets(sets, *grains).agg(*measures, F.grouping_id().alias("_gid"))
    if materialize:
        checkpoint_root(df.sparkSession)
        agg = agg.checkpoint(eager=True)
    return agg


def grain(agg: DataFrame, grains: Sequence[str], name: str) -> DataFrame:
    """Rows of one grain, keyed by its column only."""
    gid = grain_id(list(grains).index(name), len(grains))
    others = [g for g in grains if g != name]
    return agg.where(F.col("_gid") == gid).drop("_gid", *others)


def total_row(agg: DataFrame, grains: Sequence[str]) -> DataFrame:
    """The row over everything of ``grouped_once(include_total=True)``, without keys."""
    return agg.where(F.col("_gid") == (1 << len(grains)) - 1).drop("_gid", *grains)
