"""Rows that come too late: told apart before the windows, counted, stored, and added to closed windows afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellmart.sources.readers import exists
from cellmart.streaming.windows import WINDOW

LATENESS_SECONDS = 10
WINDOW_MICROS = 300 * 1_000_000
POLL = "30 seconds"


def _mark(spark: SparkSession, path: str, batch: int):
    """The newest event time of the batches before ``batch``."""
    if not exists(spark, f"{path}/marks"):
        return None
    marks = spark.read.schema("newest timestamp, batch long").parquet(f"{path}/marks")
    return marks.where(F.col("batch") < batch).agg(F.max("newest")).first()[0]


def sort_out(
    source: DataFrame,
    path: str,
    checkpoint: str,
    lateness: int = LATENESS_SECONDS,
    at: str = "event_time",
    available_now: bool = False,
    poll: str = POLL,
) -> StreamingQuery:
    """Start a stream that stores every row of ``source`` under ``path``, marked ``late`` if its window was closed when it came.

    A window is closed when the newest event of earlier batches is ``lateness`` seconds past its end: the watermark that a window job over
    the same batches has. A job over :func:`in_time` never drops a row, however it batches them, since it is never ahead. A
    batch has a folder of its own and is written once; one that runs again finds it there.
    """

    def run(rows: DataFrame, batch: int) -> None:
        spark, folder = rows.sparkSession, f"{path}/rows/batch={batch}"
        if not exists(spark, f"{folder}/_SUCCESS"):
            mark = _mark(spark, path, batch)
            behind = F.lit(False)
            if mark is not None:
                # by hand, since window() would leave out rows without a time
                end = (F.floor(F.unix_micros(at) / WINDOW_MICROS) + 1) * WINDOW_MICROS
                behind = end + lateness * 1_000_000 <= F.unix_micros(F.lit(mark).cast("timestamp"))
            # rows without a time are in no window
            split = rows.withColumn("late", F.coalesce(behind, F.lit(False)).cast("string"))
            split.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("late").parquet(folder)
        newest = stored_rows(spark, path, rows.schema).where(F.col("batch") == batch).agg(F.max(at).alias("newest"))
        newest.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/marks/batch={batch}")

    writer = source.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)).start()


def _fields(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("batch", T.LongType()), T.StructField("late", T.StringType())])


def stored_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with ``batch`` and ``late``, both folders."""
    return spark.read.schema(_fields(schema)).parquet(f"{path}/rows")


def in_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows that were not late, as a stream for a window job."""
    rows = spark.readStream.schema(_fields(schema)).parquet(f"{path}/rows")
    return rows.where("late = 'false'").select(*schema.names)


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return stored_rows(spark, path, schema).where("late = 'true'").drop("late")


def late_counts(spark: SparkSession, path: str, schema: T.StructType, at: str = "event_time") -> DataFrame:
    """Late rows per batch and window."""
    counts = late_rows(spark, path, schema).groupBy("batch", F.window(at, WINDOW).alias("window")).agg(F.count(F.lit(1)).alias("late_cnt"))
    return counts.select("batch", F.col("window.start").alias("window_start"), "late_cnt")


def corrected(sink: DataFrame, late: DataFrame, sums: tuple[str, ...] = ("total_val", "record_cnt")) -> DataFrame:
    """Closed windows with the windows of late rows, made by the same core, added to them; the sink itself stays."""
    sums = tuple(c for c in sums if c in sink.columns)
    keys = [c for c in sink.columns if c not in sums]
    return sink.unionByName(late.select(*sink.columns)).groupBy(*keys).agg(*[F.sum(c).alias(c) for c in sums])
