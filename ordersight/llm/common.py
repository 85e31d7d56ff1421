"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="ordersight-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared scratch folder."""
    return f"{scratch_root(spark)}/ordersight/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: lineage ends there."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def hashed_sample(df: DataFrame, by: list[str], n: int, over: int = 4, distinct: bool = False) -> DataFrame:
    """At most ``n`` rows of ``df``: those with the smallest hashes of the columns ``by``; with ``distinct`` one row for equal ones.

    Rows are first thinned by hash to about ``over`` times ``n``, so that tasks
    pass on few rows each, however many tasks there are.
    """
    rows = thinned(df, by, over * n, distinct)
    return (rows.dropDuplicates(by) if distinct else rows).orderBy(F.xxhash64(*by), *by).limit(n)


def thinned(df: DataFrame, by: list[str], n: int, distinct: bool = False) -> DataFrame:
    """About ``n`` rows of ``df`` (all, if it has fewer), picked by hash of the columns ``by``.

    With ``distinct`` rows that are equal in ``by`` count as one; either all or none of them are picked.
    """
    rows = df.agg(F.approx_count_distinct(F.xxhash64(*by), 0.02)).first()[0] if distinct else df.count()
    if rows <= n:
        return df
    return df.filter(F.pmod(F.xxhash64(*by), F.lit(1 << 40)) < F.lit(int(n / rows * (1 << 40))))


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file on the driver; workers get its bytes, not its path."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
