"""Equal-width histogram of order amounts.

The bounds are one global aggregate used as a scalar subquery: Spark runs it
once, inlines the two values into the bucketing expression and needs neither
a join with the data nor a trip through the driver. Counting is a map-side
partial count per bucket, so at most ``bins`` rows per task are shuffled.
Two scans of the amount column in all: one for the bounds, one to count.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordersight.functions.money import cents


def amount_histogram(df: DataFrame, bins: int = 50, column: str = "final_amount", bounds: DataFrame | None = None) -> DataFrame:
    """``bins`` equal-width buckets over [min, max]; the last one is closed.

    Returns every bucket (empty ones with n = 0): bucket, bucket_low,
    bucket_high, n. When all values are equal they all land in bucket 0; an
    input without values gives no rows. Bucketing is exact integer arithmetic
    on cents (exact while (max - min) in cents times ``bins`` stays below 2^53).
    ``bounds`` is one row (lo, hi) of the column's extremes, if known already.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    vals = df.select(cents(F.col(column)).alias("_c")).where(F.col("_c").isNotNull())
    if bounds is None:
        bounds = vals.agg(F.min("_c").alias("lo"), F.max("_c").alias("hi"))
    else:
        bounds = bounds.select(cents(F.col("lo")).alias("lo"), cents(F.col("hi")).alias("hi"))
    b = bounds.select(F.struct("lo", "hi")).scalar()
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    span = hi - lo
    bucket = F.when(span == 0, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_c") - lo) * bins / span), F.lit(bins - 1))
    ).cast("bigint")
    # Only the counting branch references the bounds (one subquery, reused
    # for every use in it); the bounds ride along on the counted rows.
    counts = (
        vals.select("_c", b.alias("_b"))
        .groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(lo).alias("_lo"), F.min(hi).alias("_hi"))
    )
    # Dense buckets: a ``bins``-row grid; the window spans those rows only.
    whole = Window.partitionBy()
    dense = (
        df.sparkSession.range(bins)
        .select(F.col("id").alias("bucket"))
        .join(counts, "bucket", "left")
        .select(
            "bucket",
            F.coalesce("n", F.lit(0)).alias("n"),
            F.max("_lo").over(whole).alias("_lo"),
            F.max("_hi").over(whole).alias("_hi"),
        )
        .where(F.col("_lo").isNotNull())
    )

    def edge(i):
        return (
            F.col("_lo").cast("double") + ((F.col("_hi") - F.col("_lo")) * i).cast("double") / F.lit(bins)
        ) / F.lit(100)

    return dense.select(
        "bucket",
        edge(F.col("bucket")).alias("bucket_low"),
        edge(F.col("bucket") + 1).alias("bucket_high"),
        "n",
    ).orderBy("bucket")


#: Steps that read well, in cents: 1, 2 or 5 times a power of ten.
NICE_STEPS = tuple(d * 10**k for k in range(17) for d in (1, 2, 5))


def amount_histogram_nice(df: DataFrame, bins: int = 50, column: str = "final_amount") -> DataFrame:
    """At most ``bins`` buckets of a step that reads well: bucket, bucket_low, bucket_high, n.

    The step is the smallest of ``NICE_STEPS`` that covers [min, max] with at most
    ``bins`` buckets, each of which starts at a multiple of the step. Every bucket
    from the one of the smallest to the one of the largest value is there,
    numbered from 0; equal values give one bucket of one cent, no values no rows.
    """
    if bins < 1:
        raise ValueError("bins must be >= 1")
    vals = df.select(cents(F.col(column)).alias("_c")).where(F.col("_c").isNotNull())
    ends = vals.agg(F.min("_c").alias("lo"), F.max("_c").alias("hi"))

    def place(value, step):
        """The number of the step that ``value`` falls into, rounded down also below zero."""
        return ((value - F.pmod(value, step)) / step).cast("bigint")

    fits = F.filter(
        F.array(*[F.lit(s).cast("bigint") for s in NICE_STEPS]),
        lambda s: place(F.col("hi"), s) - place(F.col("lo"), s) < bins,
    )
    chosen = ends.where(F.col("lo").isNotNull()).select("lo", "hi", F.array_min(fits).alias("step"))
    step = chosen.select("step").scalar()
    counts = vals.select("_c", step.alias("_s")).groupBy(place(F.col("_c"), F.col("_s")).alias("at")).agg(F.count(F.lit(1)).alias("n"))
    first, last = (place(F.col(c), F.col("step")) for c in ("lo", "hi"))
    grid = chosen.select("step", first.alias("first"), F.explode(F.sequence(first, last)).alias("at"))
    cent = lambda c: c.cast("double") / 100
    return (
        grid.join(counts, "at", "left")
        .select(
            (F.col("at") - F.col("first")).alias("bucket"),
            cent(F.col("at") * F.col("step")).alias("bucket_low"),
            cent((F.col("at") + 1) * F.col("step")).alias("bucket_high"),
            F.coalesce("n", F.lit(0)).alias("n"),
        )
        .orderBy("bucket")
    )
