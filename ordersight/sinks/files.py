"""Writers. Every writer is distributed: tasks write their own files and the
driver only commits. Single-file output is offered only after a row limit."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordersight.functions.dates import month_label
from ordersight.operators.selection import first_n
from ordersight.operators.tables import project_columns
from ordersight.session import scratch_path, settings
from ordersight.sources.parquet import file_inventory

# Fixed format: NULL is an empty field, an empty string is "", blanks stay.
CSV_OPTIONS = {"header": "true", "escape": '"', "quote": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
CSV_WRITE = {"nullValue": "", "emptyValue": '""'}
# The reader gives unquoted empty fields this mark, which no text holds, and then NULL.
CSV_READ = {"nullValue": "\x00NULL\x00", "emptyValue": "", "multiLine": "true"}


def export_file_name(prefix: str = "filtered_orders_data", suffix: str = ".csv", now: _dt.datetime | None = None) -> str:
    """'prefix_YYYYmmdd_HHMMSS.csv', stamped once on the driver."""
    return f"{prefix}_{(now or _dt.datetime.now()).strftime('%Y%m%d_%H%M%S')}{suffix}"


def write_sample(df: DataFrame, path: str, n: int = 100, key: str = "order_id") -> str:
    """First ``n`` rows (in ``key`` order) as one parquet file, overwriting.

    The ``n``-th key is searched first (``first_n``), so the writing task reads ``n`` rows
    and no more; ``df`` should be a stored table or a scan.
    """
    first_n(df, n, key).coalesce(1).sortWithinPartitions(F.asc_nulls_last(key)).write.mode("overwrite").parquet(path)
    return path


def write_csv(
    df: DataFrame,
    path: str,
    columns: Sequence[str] | None = None,
    *,
    single_file: bool = False,
    mode: str = "overwrite",
) -> str:
    """Header CSV with doubled quotes inside quoted fields (pandas style).

    ``single_file`` coalesces to one task; use it only on bounded output
    (e.g. after a row limit).
    """
    out = project_columns(df, columns) if columns is not None else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode(mode).options(**CSV_OPTIONS, **CSV_WRITE).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read back a CSV written by ``write_csv`` with a declared schema."""
    return spark.read.options(**CSV_OPTIONS, **CSV_READ).schema(schema).csv(path)


def write_named_csv(df: DataFrame, folder: str, now: _dt.datetime | None = None, columns: Sequence[str] | None = None) -> str:
    """Bounded output as one CSV file ``folder``/``export_file_name()``; its path.

    Spark names its own part files, so the one that a single task wrote is moved
    to its name through the file system that holds ``folder``.
    """
    spark = df.sparkSession
    target = f"{folder.rstrip('/')}/{export_file_name(now=now)}"
    staged = write_csv(df, f"{target}.parts", columns, single_file=True)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(target).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    [part] = [f.getPath() for f in fs.globStatus(path(f"{staged}/part-*.csv"))]
    if fs.exists(path(target)) or not fs.rename(part, path(target)):
        raise FileExistsError(f"cannot create {target}")
    fs.delete(path(staged), True)
    return target


def append_orders(df: DataFrame, path: str) -> str:
    """Append a batch as new files; existing files are never rewritten."""
    df.write.mode("append").parquet(path)
    return path


def write_rows_per_file(df: DataFrame, path: str, rows: int) -> str:
    """Write files of at most ``rows`` rows each; every task cuts its own output, so nothing is shuffled."""
    if rows < 1:
        raise ValueError("rows per file must be >= 1")
    df.write.mode("overwrite").option("maxRecordsPerFile", rows).parquet(path)
    return path


def write_sized(df: DataFrame, path: str, n_files: int, max_rows_per_file: int | None = None) -> str:
    """Spread rows over ``n_files`` tasks; optionally cap rows per file."""
    writer = df.repartition(n_files).write.mode("overwrite")
    if max_rows_per_file:
        writer = writer.option("maxRecordsPerFile", int(max_rows_per_file))
    writer.parquet(path)
    return path


# -- files of a wanted size ---------------------------------------------------------

#: How far the mean file may be from the wanted size before the write is corrected.
SIZE_TOLERANCE = 0.2
#: Rows of the trial write that tells how many file bytes a shuffled byte becomes.
TRIAL_ROWS = 200_000
#: Pieces that the shuffle is cut into for every wanted file: they are what files are put together from.
PIECES = 12
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_REBALANCE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    "spark.sql.adaptive.rebalancePartitionsSmallPartitionFactor": "0.5",
}


def _rebalanced(df: DataFrame, path: str, advisory: int, files: int) -> None:
    """Write ``df`` by ``REBALANCE`` with an advisory size in shuffled bytes."""
    wanted = _REBALANCE | {_ADVISORY: str(max(advisory, 1)), "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(max(PIECES * files, 1))}
    with settings(df.sparkSession, wanted):
        df.hint("rebalance").write.mode("overwrite").parquet(path)


def _written(spark: SparkSession, path: str) -> tuple[int, int]:
    """(files, bytes) under ``path``."""
    row = file_inventory(spark, path).agg(F.count(F.lit(1)), F.sum("size_bytes")).first()
    return row[0], row[1] or 0


def write_target_size(df: DataFrame, path: str, target_bytes: int) -> DataFrame:
    """Write parquet files of about ``target_bytes`` each; their inventory.

    Spark's ``REBALANCE`` joins small and splits large partitions to an advisory
    size, but counts it in shuffled bytes. A trial write of a part of the rows
    tells what those become on disk; the inventory of the result is compared
    with the target, and a write that is off by over a fifth is done once more
    with the measured ratio. Skewed partitions of the input make no difference.
    ``df`` should be a stored table or a scan, as it is read up to three times.
    """
    if target_bytes < 1:
        raise ValueError("target size must be >= 1 byte")
    spark = df.sparkSession
    rows = df.count()
    if rows == 0:
        df.write.mode("overwrite").parquet(path)
        return file_inventory(spark, path)
    trial = scratch_path(spark, "trial")
    part = df if rows <= TRIAL_ROWS else df.sample(TRIAL_ROWS / rows, seed=0)
    part.write.parquet(trial)
    size = _written(spark, trial)[1] * max(rows / TRIAL_ROWS, 1.0)
    files = max(round(size / target_bytes), 1)
    ratio = 1.0
    for attempt in range(3):
        _rebalanced(df, path, round(target_bytes / ratio), files)
        n, total = _written(spark, path)
        files = max(round(total / target_bytes), 1)
        if files == n or abs(total / n - target_bytes) <= SIZE_TOLERANCE * target_bytes:
            break
        # A file holds about ``target_bytes / ratio`` shuffled bytes and came out at total / n.
        ratio *= (total / n) / target_bytes
    return file_inventory(spark, path)


# -- verified writes --------------------------------------------------------------------


class WriteMismatch(RuntimeError):
    """The files do not hold the rows that were written."""


def _checks(columns: Sequence[str]) -> list[Column]:
    """Row count and a checksum that does not depend on the order of the rows."""
    names = [F.col(f"`{c}`") for c in columns]
    # NULL leaves a hash as it is, so the pattern of NULLs is hashed too.
    holes = [F.isnull(c) for c in names]
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.xxhash64(*names, *holes).cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("checksum")]


def verify_written(spark: SparkSession, path: str, rows: int, checksum, schema: T.StructType) -> DataFrame:
    """One row (rows, checksum) read back from ``path``, or ``WriteMismatch``."""
    try:
        found = spark.read.schema(schema).parquet(path).agg(*_checks(schema.names)).first()
    except AnalysisException as exc:
        raise WriteMismatch(f"{path} cannot be read: {exc.getCondition()}") from exc
    if (found["rows"], found["checksum"]) != (rows, checksum):
        raise WriteMismatch(f"{path} holds {found['rows']} rows (checksum {found['checksum']}), {rows} rows (checksum {checksum}) were written")
    return spark.createDataFrame([(rows, checksum)], "rows long, checksum decimal(38,0)")


def write_verified(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """Write parquet and compare what the files hold with what went in: one row (rows, checksum), or ``WriteMismatch``.

    Rows are counted and summed up as hashes while they are written
    (``Observation``), so the input is not computed twice; the files are read once.
    ``mode`` is "overwrite" or "errorifexists": files of an earlier write would not count.
    """
    if mode not in ("overwrite", "errorifexists"):
        raise ValueError("a verified write replaces the folder or fails")
    seen = Observation(f"write-{path}")
    df.observe(seen, *_checks(df.columns)).write.mode(mode).parquet(path)
    got = seen.get
    return verify_written(df.sparkSession, path, got["rows"], got["checksum"], df.schema)


# -- a lake by month ----------------------------------------------------------------------

LAKE_KEY = "order_month"
#: Months that a task writes side by side, without sorting its rows by month first; the rows of further months are sorted.
OPEN_MONTHS = 32


def export_lake(df: DataFrame, path: str, gathered: bool = False) -> str:
    """Write orders under ``order_month=yyyy-MM`` folders, replacing the months that ``df`` holds and no others.

    A rerun over some months leaves the rest as it is (dynamic partition
    overwrite). Rows are gathered by month first, so that a month is a few
    files; a large month is split by size (``REBALANCE``). Orders without a
    date go to Spark's folder for NULL. ``gathered`` says that the files of ``df``
    hold a few months each already, so that nothing is shuffled.
    """
    dated = df.withColumn(LAKE_KEY, month_label(F.col("order_date")))
    if not gathered:
        dated = dated.hint("rebalance", F.col(LAKE_KEY))
    with settings(df.sparkSession, {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_MONTHS)}):
        dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy(LAKE_KEY).parquet(path)
    return path


def read_lake(spark: SparkSession, path: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """Orders of the months ``first`` to ``last`` ('yyyy-MM', both included, None is open); other folders are not opened."""
    schema = spark.read.parquet(path).schema  # the months could be taken for dates
    fields = [T.StructField(f.name, T.StringType() if f.name == LAKE_KEY else f.dataType) for f in schema]
    orders = spark.read.schema(T.StructType(fields)).parquet(path)
    if first is not None:
        orders = orders.where(F.col(LAKE_KEY) >= first)
    if last is not None:
        orders = orders.where(F.col(LAKE_KEY) <= last)
    return orders
