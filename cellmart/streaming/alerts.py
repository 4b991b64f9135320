"""A running alert on response times: a mergeable sketch per interval, sessions of breaching intervals."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# relative error of a quantile
ERROR = 0.01
# values up to this count as it
LEAST = 1e-9


def bucket_of(value: Column, error: float = ERROR) -> Column:
    """The bucket of a value: bounds grow by one factor, so a bucket's middle is within ``error`` of all its values."""
    factor = (1 + error) / (1 - error)
    return F.ceil(F.log(F.greatest(value.cast("double"), F.lit(LEAST))) / F.lit(math.log(factor))).cast("int")


def value_of(bucket: Column, error: float = ERROR) -> Column:
    factor = (1 + error) / (1 - error)
    return F.lit(2 / (factor + 1)) * F.pow(F.lit(factor), bucket)


def quantile(buckets: Column, total: Column, p: float, error: float = ERROR) -> Column:
    """Interpolated quantile of counts ``buckets(bucket, n)``, which may come in any order; within ``error`` of the exact one."""
    ordered = F.array_sort(buckets)
    rank = F.lit(p) * (total - 1)

    def at(row: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("int").alias("bucket"))

        def step(state: Column, x: Column) -> Column:
            upto = state["seen"] + x["n"]
            hit = state["bucket"].isNull() & (row < upto)
            return F.struct(upto.alias("seen"), F.when(hit, x["bucket"]).otherwise(state["bucket"]).alias("bucket"))

        return value_of(F.aggregate(ordered, start, step)["bucket"], error)

    low, high = at(F.floor(rank)), at(F.ceil(rank))
    return low + (high - low) * (rank - F.floor(rank))


def latency_alerts(
    timings: DataFrame,
    group: str = "engine",
    value: str = "elapsed_sec",
    at: str = "started_at",
    limit: float = 3.0,
    run: int = 5,
    every: str = "1 minute",
    p: float = 0.95,
) -> DataFrame:
    """Stretches of at least ``run`` consecutive intervals whose quantile exceeds ``limit``, on a stream with a watermark on ``at`` or a batch.

    The counts per logarithmic bucket are the sketch: they add up in any order, at most some thousand per group and interval, however many
    timings there are. Three append-safe aggregations: counts, intervals, and sessions of breaching
    intervals; a stretch is emitted once, when no interval that would prolong it can come any more. Failed runs
    (below 0) are left out by one condition on the time, so they still move the watermark.
    """
    rows = timings.where(F.when(F.col(at).isNotNull(), F.col(value) >= 0)).withColumn("_bucket", bucket_of(F.col(value)))
    counts = rows.groupBy(F.window(at, every).alias("window"), group, "_bucket").agg(F.count(F.lit(1)).alias("n"))
    slots = counts.groupBy("window", group).agg(
        F.collect_list(F.struct(F.col("_bucket").alias("bucket"), "n")).alias("_buckets"), F.sum("n").alias("_total")
    )
    slots = slots.withColumn("p95_sec", quantile(F.col("_buckets"), F.col("_total"), p)).where(F.col("p95_sec") > limit)
    # the next interval's time is one interval later: within the gap; the one after is not
    gap = f"{_seconds(every) * 3 // 2} seconds"
    found = slots.withColumn("_moment", F.window_time("window")).groupBy(group, F.session_window("_moment", gap).alias("_session")).agg(
        F.min("window.start").alias("first_slot"),
        F.max("window.start").alias("last_slot"),
        F.count(F.lit(1)).alias("slots"),
        F.max("p95_sec").alias("worst_p95_sec"),
    )
    return found.where(F.col("slots") >= run).drop("_session")


def _seconds(every: str) -> int:
    count, unit = every.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]
