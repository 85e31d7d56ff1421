"""Parquet sources: multi-file and multi-folder scans, probes and inventories.

Nothing here lists files on the driver's local disk: discovery goes through
Spark's own file index, so the same code works on HDFS or object stores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.operators.selection import first_n
from ordersight.schema import SchemaMismatch, conform


class SourceNotFound(FileNotFoundError):
    """No readable parquet data at the given location(s)."""


_MISSING_CONDITIONS = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


PARQUET_GLOB = "*.parquet"


def _is_missing(exc: AnalysisException) -> bool:
    condition = exc.getCondition() or ""
    return any(c in condition or c in str(exc) for c in _MISSING_CONDITIONS)


def _scan(spark: SparkSession, paths: list[str], merge_schema: bool) -> DataFrame:
    """The parquet files of ``paths``; other files beside them are not looked at."""
    try:
        reader = spark.read.option("mergeSchema", str(merge_schema).lower()).option("pathGlobFilter", PARQUET_GLOB)
        return reader.parquet(*paths)
    except AnalysisException as exc:
        if _is_missing(exc):
            raise SourceNotFound(f"no parquet data at {paths}: {exc.getCondition()}") from exc
        raise


def read_orders(
    spark: SparkSession,
    *paths: str,
    merge_schema: bool = False,
    on_drift: str = "fail",
    conform_schema: bool = True,
    strict: bool = True,
) -> DataFrame:
    """Scan one or more parquet folders/files as one orders table.

    ``on_drift="fail"`` is one scan: all files must share a schema (a column
    present in only some files is dropped unless ``merge_schema``; an int/long
    clash fails the task). ``on_drift="widen"`` scans each path on its own,
    conforms each to the declared schema and unions by name, so differing
    physical types across folders are reconciled explicitly.
    """
    if not paths:
        raise SourceNotFound("no paths given")
    if on_drift == "widen":
        parts = [conform(_scan(spark, [p], merge_schema), strict=strict) for p in paths]
        return reduce(lambda a, b: a.unionByName(b), parts)
    if on_drift != "fail":
        raise ValueError(f"on_drift must be 'fail' or 'widen', not {on_drift!r}")
    df = _scan(spark, list(paths), merge_schema)
    return conform(df, strict=strict) if conform_schema else df


def read_first(spark: SparkSession, n: int, *paths: str, key: str = "order_id", **options) -> DataFrame:
    """``read_orders`` capped at its first ``n`` rows in ``key`` order; the others are not loaded."""
    return first_n(read_orders(spark, *paths, **options), n, key)


def read_many(
    spark: SparkSession,
    paths: list[str] | tuple[str, ...],
    *,
    conform_schema: bool = True,
) -> DataFrame:
    """UNION ALL of every existing source folder, duplicates kept.

    Missing folders are skipped; if none exists, ``SourceNotFound``. Schemas
    must agree in column names and types, or ``SchemaMismatch`` is raised, like
    a strict table concatenation; ``read_orders(on_drift="widen")`` reconciles.
    """
    frames = []
    for p in paths:
        try:
            frames.append(_scan(spark, [p], False))
        except SourceNotFound:
            continue
    if not frames:
        raise SourceNotFound(f"none of {list(paths)} holds parquet data")
    kinds = [sorted((f.name, f.dataType.simpleString()) for f in frame.schema.fields) for frame in frames]
    if any(k != kinds[0] for k in kinds):
        raise SchemaMismatch(f"folders differ in schema: {[sorted(set(k) ^ set(kinds[0])) for k in kinds[1:]]}")
    df = reduce(lambda a, b: a.unionByName(b), frames)
    return conform(df) if conform_schema else df


def first_available(spark: SparkSession, paths: list[str] | tuple[str, ...]) -> tuple[bool, str | None, int]:
    """(True, path, number of files) for the first path with parquet data; only counts reach the driver."""
    for p in paths:
        try:
            files = file_listing(spark, p).count()
        except AnalysisException as exc:
            if not _is_missing(exc):
                raise
            continue
        if files:
            return True, p, files
    return False, None, 0


def file_listing(spark: SparkSession, path: str) -> DataFrame:
    """Parquet files under ``path`` with their byte sizes; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", PARQUET_GLOB)
        .load(path)
        .select(F.col("path").alias("file_path"), F.col("length").alias("size_bytes"))
    )


def file_inventory(spark: SparkSession, path: str) -> DataFrame:
    """One row per parquet file, also without rows: name, path, bytes, MB (2 dp) and row count.

    The file listing, joined with one scan without data columns (parquet
    answers from footers); both take the path from the file's own metadata, so
    it is encoded alike, as Spark writes it.
    """
    counts = _scan(spark, [path], False).groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    files = spark.read.format("binaryFile").option("pathGlobFilter", PARQUET_GLOB).load(path).select(
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("size_bytes"),
    )
    return (
        files.join(counts, "file_path", "left")
        .select(
            "file_name",
            "file_path",
            "size_bytes",
            F.round(F.col("size_bytes") / F.lit(1024 * 1024), 2).alias("size_mb"),
            F.coalesce("n", F.lit(0)).alias("n_rows"),
        )
        .orderBy("file_path")
    )


def file_summary(spark: SparkSession, path: str) -> DataFrame:
    """Per-file rows and sizes plus a TOTAL line; files of equal name in different folders stay apart."""
    inv = file_inventory(spark, path)
    return (
        inv.groupingSets([["file_path", "file_name"], []], "file_path", "file_name")
        .agg(
            F.sum("n_rows").cast("bigint").alias("n_rows"),
            F.sum("size_bytes").cast("bigint").alias("size_bytes"),
            F.grouping_id().alias("_g"),
        )
        .select(
            F.when(F.col("_g") > 0, F.lit("TOTAL")).otherwise(F.col("file_name")).alias("file_name"),
            "file_path",
            "n_rows",
            "size_bytes",
            F.round(F.col("size_bytes") / F.lit(1024**3), 2).alias("size_gb"),
            (F.col("_g") > 0).alias("is_total"),
        )
        .orderBy("is_total", "file_path")
    )


def folder_rows(inventory: DataFrame, key: str) -> DataFrame:
    """Rows per ``key=value`` folder of a partitioned write, from ``file_inventory`` or ``file_summary`` (whose total stays)."""
    folder = F.regexp_extract("file_path", f"/{key}=([^/]+)/", 1)
    if "is_total" in inventory.columns:
        folder = F.when(F.col("is_total"), F.col("file_name")).otherwise(folder)
    return inventory.groupBy(folder.alias("folder")).agg(F.sum("n_rows").cast("bigint").alias("n_rows"))
