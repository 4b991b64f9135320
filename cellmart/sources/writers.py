"""Writing tables: partition replacement, append, reload, clustering, slices."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.operators.sizing import spread_key
from cellmart.operators.upsert import upsert
from cellmart.schemas import MAIN, RESULTS, STAGING, TABLES, Table


def _partitioned(df: DataFrame, spec: Table) -> DataFrame:
    if spec.day_of:
        return df.withColumn(spec.partition_column, F.to_date(spec.day_of))
    return df


# fixed values: the keys that lookups ask for one at a time
LOOKUP_KEYS = {
    "call_quality_iceberg": ("lookup_key", "call_id"),
    "call_quality_kudu": ("lookup_key", "call_id"),
    "call_quality_kudu_by_call": ("call_id",),
}


def _with_filters(writer, table: str):
    """Bloom filters on the lookup keys, as large as each row group's keys need: a row group without a key is not read even where its
    smallest and largest key enclose it."""
    for column in LOOKUP_KEYS.get(table, ()):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    return writer.option("parquet.bloom.filter.adaptive.enabled", "true") if table in LOOKUP_KEYS else writer


def _target(df: DataFrame, spec: Table, mode: str):
    writer = df.write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
    if spec.name == "call_quality_iceberg":
        writer = writer.option("parquet.block.size", 128 * 1024 * 1024)
    writer = _with_filters(writer, spec.name)
    return writer.partitionBy(spec.partition_column) if spec.partition_column else writer


def publish_dim(df: DataFrame, path: str) -> None:
    """Store a dimension as a new version and name it the current one last.

    Files of earlier versions stay, so a stream or a query that reads one of them goes on, and joins can go back in time.
    """
    version = uuid.uuid4().hex
    df.write.option("compression", "zstd").parquet(f"{path}/versions/version={version}")
    named = df.sparkSession.range(1).select(F.lit(version).alias("version"), F.current_timestamp().alias("published_at"))
    named.write.mode("append").parquet(f"{path}/published")


def overwrite_partitions(df: DataFrame, path: str, table: str) -> None:
    """Replace the partitions present in ``df``; of a dimension, a new version is published."""
    spec = TABLES[table]
    if spec.is_dim:
        publish_dim(df, path)
        return
    _target(_partitioned(df, spec), spec, "overwrite").parquet(path)


def append(df: DataFrame, path: str, table: str) -> None:
    spec = TABLES[table]
    _target(_partitioned(df, spec), spec, "append").parquet(path)


def reload(df: DataFrame, path: str, table: str) -> None:
    """Purge the whole table, then load ``df``."""
    spec = TABLES[table]
    writer = _target(_partitioned(df, spec), spec, "overwrite").option("partitionOverwriteMode", "static")
    writer.parquet(path)


def clustered(df: DataFrame, table: str, partitions: int | None = None) -> DataFrame:
    """Range-cluster on the table's sort column, so file and row-group ranges skip well.

    The partition column leads the range, which keeps each file inside few
    partitions, and a hash ends it, so a key with very many rows spreads over
    several files.
    """
    spec = TABLES[table]
    df = _partitioned(df, spec)
    lead = [c for c in (spec.partition_column, spec.sort_by or spec.bucket_by) if c]
    keys = [*lead, "_spread"]
    placed = df.withColumn("_spread", spread_key(df))
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).drop("_spread")


def write_clustered(df: DataFrame, path: str, table: str, partitions: int | None = None) -> None:
    spec = TABLES[table]
    _target(clustered(df, table, partitions), spec, "overwrite").parquet(path)


def ingest_slice(spark: SparkSession, source: DataFrame, path: str, table: str, value: str | None = None) -> None:
    """Copy one partition of a source warehouse (or a whole dimension) into our table."""
    spec = TABLES[table]
    if value is not None:
        part = F.to_date(spec.day_of).cast("string") if spec.day_of else F.col(spec.partition_column)
        source = source.where(part == value)
        if spec.day_of and spec.partition_column in source.columns:
            # a stored source is read in this day's partition only
            source = source.where(F.col(spec.partition_column) == F.lit(value).cast("date"))
    overwrite_partitions(source.select(*spec.schema.names), path, table)


def ingest_slices(spark: SparkSession, source: DataFrame, path: str, table: str, at_once: int = 31) -> None:
    """Copy every partition of a source table, oldest first, ``at_once`` partitions per job.

    A job that runs again replaces the partitions it holds, so a copy that broke off is simply started again.
    """
    spec = TABLES[table]
    part = F.to_date(spec.day_of).cast("string") if spec.day_of else F.col(spec.partition_column)
    stored = spec.partition_column if spec.partition_column in source.columns else None
    # of a stored source these are folder names, no rows
    named = (F.col(stored).cast("string") if stored else part).alias("part")
    values = [r["part"] for r in source.select(named).distinct().orderBy("part").toLocalIterator()]
    for at in range(0, len(values), at_once):
        some = values[at : at + at_once]
        known = [v for v in some if v is not None]
        slices = named.isin(*known) | (F.lit(None in some) & named.isNull())
        rows = source.where(slices)
        if stored and known:
            kind = source.schema[stored].dataType
            rows = source.where(F.col(stored).isin(*[F.lit(v).cast(kind) for v in known]) | (F.lit(None in some) & F.col(stored).isNull()))
        overwrite_partitions(rows.select(*spec.schema.names), path, table)


def create_databases(spark: SparkSession) -> None:
    for name in (MAIN, STAGING, RESULTS):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def create_table(spark: SparkSession, table: str, database: str = MAIN, location: str | None = None) -> str:
    """Declare one table of the model; returns its qualified name."""
    spec = TABLES[table]
    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in spec.schema.fields]
    if spec.day_of:
        columns.append(f"`{spec.partition_column}` date")
    clauses = [f"CREATE TABLE IF NOT EXISTS {database}.{table} ({', '.join(columns)}) USING parquet"]
    if spec.partition_column:
        clauses.append(f"PARTITIONED BY (`{spec.partition_column}`)")
    if spec.buckets:
        clauses.append(f"CLUSTERED BY (`{spec.bucket_by}`) SORTED BY (`{spec.bucket_by}`) INTO {spec.buckets} BUCKETS")
    if location:
        clauses.append(f"LOCATION '{location}'")
    spark.sql(" ".join(clauses))
    return f"{database}.{table}"


def create_tables(spark: SparkSession, database: str = MAIN) -> list[str]:
    return [create_table(spark, name, database) for name in TABLES]


def write_bucketed(
    df: DataFrame, table: str, name: str, path: str | None = None, buckets: int | None = None, files: int = 4
) -> None:
    """Store a keyed table hash-bucketed and sorted on its key.

    Each task writes one of the ``files`` parts of one bucket, chosen by a hash of
    the whole row: a bucket inflated by one busy key is shared by several tasks.
    """
    spec = TABLES[table]
    count = buckets or spec.buckets
    bucket = F.pmod(F.hash(spec.bucket_by), F.lit(count))
    placed = df.withColumn("_task", bucket * files + F.pmod(spread_key(df), F.lit(files)).cast("int"))
    writer = placed.repartitionById(count * files, "_task").drop("_task").write.mode("overwrite").format("parquet")
    writer = _with_filters(writer, table)
    if path:
        writer = writer.option("path", path)
    writer.bucketBy(count, spec.bucket_by).sortBy(spec.bucket_by).saveAsTable(name)


def load_drop(spark: SparkSession, staging: str, warehouse: str) -> None:
    """Load a staged drop: the dimension replaces the old one, the raw facts are appended."""
    from cellmart.sources.readers import read_dim, read_raw

    staging = staging.rstrip("/")
    overwrite_partitions(read_dim(spark, f"{staging}/bts_master.parquet"), f"{warehouse}/bts_master", "bts_master")
    for table in ("cdr_sgi_raw", "cdr_mdt_smsng_raw"):
        append(read_raw(spark, f"{staging}/{table}.parquet", table), f"{warehouse}/{table}", table)


def _switch(spark: SparkSession, view: str, version: str) -> None:
    spark.sql(f"CREATE OR REPLACE VIEW {view} AS SELECT * FROM {version}")


def publish_keyed(
    rows: DataFrame, view: str, table: str = "call_quality_kudu", buckets: int | None = None, files: int = 4
) -> str:
    """Store ``rows`` as a new bucketed version of a keyed table and point ``view`` at it last; returns the version's name.

    Written from the view itself, it is a compaction: ``files`` parts per bucket, whatever there were before.
    """
    version = f"{view}_v{uuid.uuid4().hex}"
    write_bucketed(rows, table, version, buckets=buckets, files=files)
    _switch(rows.sparkSession, view, version)
    return version


def publish_upsert(
    spark: SparkSession,
    base: DataFrame,
    changes: DataFrame,
    key: list[str],
    order: list[str],
    view: str,
    table: str = "call_quality_kudu",
    buckets: int | None = None,
) -> str:
    """Store the merged table as a new version in the warehouse, bucketed like ``table``, and point ``view`` at it last.

    The version being read is never overwritten, so a failed run leaves it in place. The view is in the catalog: other
    sessions see the switch, and a lookup through it reads one bucket. Returns the version's name.
    """
    return publish_keyed(upsert(base, changes, key, order), view, table, buckets)
