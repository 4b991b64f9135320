"""Running the window cores as Structured Streaming jobs."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellmart.schemas import schema
from cellmart.sources.readers import tail_table
from cellmart.streaming import windows

LATENESS = "10 seconds"
POLL = "30 seconds"
# files a micro-batch takes at most, so that a first start on a full table is no single batch
MAX_FILES = 10_000

# job -> (source table, core, sink table)
JOBS: dict[str, tuple[str, Callable[..., DataFrame], str]] = {
    "ltas": ("cdr_sgi_raw", windows.ltas, "ltas_5min_flink"),
    "sgi_v1": ("cdr_sgi_raw", windows.sgi_v1, "sgi_5min_flink"),
    "sgi_v2": ("cdr_sgi_raw", windows.sgi_v2, "sgi_5min_flink_v2"),
    "mdt": ("cdr_mdt_smsng_raw", windows.mdt, "mdt_5min_flink"),
}
# jobs whose core can take dated stations instead of those of the start
VERSIONED: dict[str, Callable[..., DataFrame]] = {
    "ltas": windows.ltas_versioned,
    "sgi_v1": windows.sgi_v1_versioned,
    "sgi_v2": windows.sgi_v2_versioned,
    "mdt": windows.mdt_versioned,
}


def closed_windows(
    job: str,
    source: DataFrame,
    bts: DataFrame,
    lateness: str = LATENESS,
    minute: str | None = windows.MINUTE,
    versioned: bool = False,
) -> DataFrame:
    """The job's result on a stream, each window emitted once it is past the watermark.

    With ``versioned``, ``bts`` holds dated stations from ``with_validity``, and each record meets those of its time.
    """
    core = VERSIONED[job] if versioned else JOBS[job][1]
    return core(source.withWatermark("event_time", lateness), bts, minute)


def write_windows(
    result: DataFrame,
    sink_path: str,
    checkpoint: str,
    available_now: bool = False,
    poll: str = POLL,
    state_partitions: int | None = None,
) -> StreamingQuery:
    """Append closed windows to a date-partitioned table, each exactly once.

    Restarting with the same checkpoint continues where the last run stopped.
    ``state_partitions`` is fixed by the first run: about the cores of the cluster
    serves a stream better than the partition count of large batch shuffles.
    """
    writer = (
        result.withColumn("window_date", F.to_date("window_start"))
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", sink_path)
        .option("checkpointLocation", checkpoint)
        .partitionBy("window_date")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)
    if state_partitions is None:
        return writer.start()
    # the query keeps the settings it was started with
    settings, name = result.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = settings.get(name)
    settings.set(name, str(state_partitions))
    try:
        return writer.start()
    finally:
        settings.set(name, before)


def start(
    spark: SparkSession,
    job: str,
    source_path: str,
    bts: DataFrame,
    sink_path: str,
    checkpoint: str,
    lateness: str = LATENESS,
    minute: str | None = windows.MINUTE,
    max_files: int | None = MAX_FILES,
    available_now: bool = False,
    state_partitions: int | None = None,
    versioned: bool = False,
) -> StreamingQuery:
    """Start one job on its raw table, joined to ``bts`` as it is at the start.

    A new version of the stations leaves the files of the old one in place, so the job goes on with those and takes the
    new ones at its next start; ``versioned`` jobs take each record's own.
    """
    source = tail_table(spark, source_path, JOBS[job][0], max_files)
    result = closed_windows(job, source, bts, lateness, minute, versioned)
    return write_windows(result, sink_path, checkpoint, available_now, state_partitions=state_partitions)


def _stored(spark: SparkSession, job: str, sink_path: str) -> DataFrame:
    fields = T.StructType([*schema(JOBS[job][2]).fields, T.StructField("window_date", T.DateType())])
    return spark.read.schema(fields).parquet(sink_path)


def read_sink(spark: SparkSession, job: str, sink_path: str, since: date | None = None) -> DataFrame:
    """Committed windows of a job's sink; of the days from ``since`` on, only those are read."""
    rows = _stored(spark, job, sink_path)
    if since is not None:
        rows = rows.where(F.col("window_date") >= F.lit(since))
    return rows.select(*schema(JOBS[job][2]).names)


def newest_days(spark: SparkSession, job: str, sink_path: str, rows: int) -> date | None:
    """The first of the newest days that hold ``rows`` rows of a sink between them, from a count per day."""
    per_day = _stored(spark, job, sink_path).groupBy("window_date").count().orderBy(F.desc("window_date"))
    day, held = None, 0
    for found in per_day.toLocalIterator():
        day, held = found["window_date"], held + found["count"]
        if held >= rows:
            break
    return day
