"""Reading tables, raw drops, seed files and table tails."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.schemas import TABLES, schema


def read_table(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A stored table with its declared schema, so partition values stay text; of a dimension, the newest version."""
    spec = TABLES[table]
    if spec.is_dim and exists(spark, f"{path}/published"):
        newest = _published(spark, path).agg(F.max_by("version", "published_at")).first()[0]
        path = f"{path}/versions/version={newest}"
    fields = spec.schema
    if spec.day_of:
        fields = T.StructType([*fields.fields, T.StructField(spec.partition_column, T.DateType(), True)])
    return spark.read.schema(fields).parquet(path)


def read_days(spark: SparkSession, path: str, table: str, days: list[str]) -> DataFrame:
    """Some partitions of a stored table. Only their folders are listed, not those of all days; a day without a folder has no rows."""
    spec = TABLES[table]
    fields = spec.schema
    if spec.day_of:
        fields = T.StructType([*fields.fields, T.StructField(spec.partition_column, T.DateType(), True)])
    folders = [f"{path}/{spec.partition_column}={day}" for day in days]
    folders = [f for f in folders if exists(spark, f)]
    if not folders:
        return spark.createDataFrame([], fields)
    return spark.read.schema(fields).option("basePath", path).parquet(*folders)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there, in whatever store the path names; nothing below it is listed."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder))


def _published(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("version string, published_at timestamp").parquet(f"{path}/published")


def read_versions(spark: SparkSession, path: str, table: str) -> DataFrame:
    """Every published version of a dimension, with ``valid_from``: when it was published."""
    fields = T.StructType([*schema(table).fields, T.StructField("version", T.StringType())])
    stored = spark.read.schema(fields).parquet(f"{path}/versions")
    # one row per version
    dated = _published(spark, path).withColumnRenamed("published_at", "valid_from")
    return stored.join(F.broadcast(dated), "version").drop("version")


def tail_table(spark: SparkSession, path: str, table: str, max_files: int | None = None) -> DataFrame:
    """The same table as an append-only stream of files."""
    spec = TABLES[table]
    fields = spec.schema
    if spec.day_of:
        fields = T.StructType([*fields.fields, T.StructField(spec.partition_column, T.DateType(), True)])
    reader = spark.readStream.schema(fields)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path).select(*spec.schema.names)


def to_event_time(df: DataFrame, column: str = "event_time") -> DataFrame:
    """Bring an event time to TIMESTAMP whatever the file held.

    Nanosecond files arrive as long and are divided as integers; microsecond
    files arrive as timestamps, with or without zone, and must not be divided.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.LongType):
        return df.withColumn(column, F.expr(f"timestamp_micros(`{column}` div 1000)"))
    return df.withColumn(column, F.col(column).cast("timestamp"))


def read_raw(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A raw Parquet drop, conformed to the declared columns and types.

    The physical type of the event time decides its conversion, so the file
    schema is read here instead of being imposed.
    """
    spark.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    raw = to_event_time(spark.read.parquet(path))
    return raw.select(*[F.col(f.name).cast(f.dataType) for f in schema(table).fields])


def read_dim(spark: SparkSession, path: str) -> DataFrame:
    """A dimension drop with the schema stored in its files."""
    return spark.read.parquet(path)


def read_seed(spark: SparkSession, path: str, table: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV with header. Empty text stays empty text; only ``\\N`` is NULL."""
    wanted = columns or schema(table).names
    fields = T.StructType([schema(table)[c] for c in wanted])
    return (
        spark.read.schema(fields)
        .option("header", True)
        .option("enforceSchema", False)
        .option("emptyValue", "")
        .option("nullValue", "\\N")
        .csv(path)
    )


def literal_rows(spark: SparkSession, table: str, rows: list[tuple], columns: list[str] | None = None) -> DataFrame:
    """A few hand-written rows of a table."""
    wanted = columns or schema(table).names
    return spark.createDataFrame(rows, T.StructType([schema(table)[c] for c in wanted]))
