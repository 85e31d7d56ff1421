"""Reuse of a load: the columns that the reports read, kept by the cluster.

``loaded`` persists a scan once per session and state of its files, spilling to
disk where memory is short; ``unload`` gives the space back. The state is a digest
of the files' paths, sizes and times, taken from the listing alone, so files
that come, go or are replaced (by whatever process) lead to a new load, and
the old one is released. Nothing is cached unless a caller asks for it.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.schema import USED_COLUMNS
from ordersight.sources.parquet import PARQUET_GLOB, read_orders

_kept: dict[tuple[str, tuple[str, ...]], tuple[tuple, DataFrame]] = {}


def _key(spark: SparkSession, paths: tuple[str, ...]) -> tuple[str, tuple[str, ...]]:
    return spark.sparkContext.applicationId, paths


def listing_digest(spark: SparkSession, *paths: str) -> tuple:
    """(files, bytes, digest) of the parquet files of ``paths``, from their listing."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", PARQUET_GLOB).load(list(paths))
    each = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(each)).first())


def loaded(spark: SparkSession, *paths: str, materialise: bool = False) -> DataFrame:
    """The orders of ``paths``, only ``USED_COLUMNS``, persisted on first use and shared until their files change.

    ``materialise`` fills the cache now, by counting the rows; else the first use does.
    """
    key, digest = _key(spark, paths), listing_digest(spark, *paths)
    if key in _kept and _kept[key][0] != digest:
        unload(spark, *paths)
    if key not in _kept:
        df = read_orders(spark, *paths).select(*USED_COLUMNS)
        _kept[key] = digest, df.persist(StorageLevel.MEMORY_AND_DISK)
    df = _kept[key][1]
    if materialise:
        df.agg(F.count(F.lit(1)), *[F.count(c) for c in USED_COLUMNS]).first()
    return df


def unload(spark: SparkSession, *paths: str) -> bool:
    """Drop what ``loaded`` keeps for ``paths``; whether there was anything."""
    _, df = _kept.pop(_key(spark, paths), (None, None))
    if df is not None:
        df.unpersist(blocking=True)
    return df is not None
