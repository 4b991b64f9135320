"""Session defaults and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    # one wall clock everywhere: event times are zone-less in the sources
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # replace only the partitions a result touches; keep YYYYMMDD partition values as text
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.parquet.filterPushdown": "true",
    # keep bucketed scans for point lookups: only the key's bucket is read
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    # checkpointed intermediates go away with the frames that use them
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # nanosecond Parquet timestamps are read as long and divided in the loader
    "spark.sql.legacy.parquet.nanosAsLong": "true",
    # window state lives off-heap, with incremental snapshots
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
}


def build_session(app_name: str = "cellmart", **conf: str) -> SparkSession:
    """Session with the defaults above; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    settings = {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local-mode session, where driver and executors are one machine, may
    fall back to a temporary folder.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="cellmart-")
        spark.conf.set("spark.checkpoint.dir", configured)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing is overwritten."""
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, and still there after lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
