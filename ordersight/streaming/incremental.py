"""Batch reports kept current as parquet files land in a folder.

The reference appends order files to a data folder (the generator writes
them one by one) and re-reads everything for each report. Here a file-source
stream reads each new file once; Spark's stateful aggregation keeps one row
per report key in the state store, checkpointed under the shared checkpoint
folder, so a restarted or retried query resumes exactly where it stopped.
Each micro-batch writes the current totals to a snapshot folder of its own and
then records it as complete; readers take the newest complete one.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ordersight.functions.dates import month_label, month_start
from ordersight.operators.reports import average
from ordersight.schema import conform
from ordersight.sources.parquet import PARQUET_GLOB


def stream_orders(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Conformed streaming orders from the parquet files of a folder, which also give the schema; other files are not looked at."""
    schema = spark.read.option("pathGlobFilter", PARQUET_GLOB).parquet(source_dir).schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", PARQUET_GLOB)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return conform(reader.parquet(source_dir))


# Running versions of the batch reports: same groups and measures, no sort
# (sort the snapshot when reading it).
def running_orders_by_status(orders: DataFrame) -> DataFrame:
    return orders.groupBy("order_status").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("final_amount").alias("total_revenue")
    )


def running_category_revenue(orders: DataFrame) -> DataFrame:
    return orders.groupBy("product_category").agg(
        F.count(F.lit(1)).alias("order_count"), F.sum("final_amount").alias("total_revenue")
    )


def running_monthly_trend(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy(month_start(F.col("order_date")).alias("_m"))
        .agg(F.count(F.lit(1)).alias("order_count"), F.sum("final_amount").alias("total_revenue"))
        .select(month_label(F.col("_m")).alias("order_month"), "order_count", "total_revenue")
    )


def running_payment_distribution(orders: DataFrame) -> DataFrame:
    return orders.groupBy("payment_method").agg(
        F.count(F.lit(1)).alias("order_count"),
        average(F.sum("final_amount"), F.count("final_amount")).alias("avg_order_value"),
    )


def running_state_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("shipping_state").agg(F.count(F.lit(1)).alias("order_count"))


RUNNING_REPORTS = {
    "orders_by_status": running_orders_by_status,
    "category_revenue": running_category_revenue,
    "monthly_trend": running_monthly_trend,
    "payment_distribution": running_payment_distribution,
    "state_counts": running_state_counts,
}


def start_snapshot(
    running: DataFrame,
    snapshot_path: str,
    checkpoint_location: str | None = None,
    *,
    available_now: bool = True,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Write the complete current result under ``snapshot_path`` every batch, one folder per epoch.

    ``available_now`` processes every file present at start, then stops
    (an incremental batch job); otherwise it runs on ``processing_time``. The
    checkpoint lies beside the snapshots unless the caller names another; one
    that starts over gives snapshots of all files again, and these are read.
    """
    spark = running.sparkSession
    checkpoint_location = checkpoint_location or f"{snapshot_path}/checkpoint"
    # Epochs restart with a new checkpoint, and the run that starts last is the one to read.
    started = time.time_ns()

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        name = f"epoch-{started}-{epoch_id}"
        batch.write.mode("overwrite").parquet(f"{snapshot_path}/{name}")
        done = spark.range(1).select(F.lit(started).cast("bigint").alias("started"), F.lit(epoch_id).cast("bigint").alias("epoch"))
        done.write.mode("append").parquet(_complete(snapshot_path))

    writer = (
        running.writeStream.outputMode("complete")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint_location)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()


def _complete(snapshot_path: str) -> str:
    return f"{snapshot_path}/complete"


def read_snapshot(spark: SparkSession, snapshot_path: str) -> DataFrame:
    """The newest snapshot that was written whole."""
    done = spark.read.schema("started bigint, epoch bigint").parquet(_complete(snapshot_path))
    newest = done.agg(F.max(F.struct("started", "epoch")).alias("at")).first()["at"]
    return spark.read.parquet(f"{snapshot_path}/epoch-{newest['started']}-{newest['epoch']}")


def refresh(
    spark: SparkSession,
    source_dir: str,
    snapshot_path: str,
    checkpoint_location: str | None = None,
    report: str = "orders_by_status",
) -> DataFrame:
    """Fold any new files into the running report and return the snapshot."""
    query = start_snapshot(RUNNING_REPORTS[report](stream_orders(spark, source_dir)), snapshot_path, checkpoint_location)
    query.awaitTermination()
    return read_snapshot(spark, snapshot_path)
