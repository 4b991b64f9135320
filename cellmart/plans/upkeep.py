"""Statistics, metadata refresh, compaction and inspection of stored tables."""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellmart.operators.sizing import measured_bytes
from cellmart.schemas import MAIN, TABLES
from cellmart.sources.readers import read_table
from cellmart.sources.writers import write_clustered

# The tables whose statistics are maintained, and the file size target.
STATS_TABLES = (
    "cdr_sgi",
    "cdr_sgi_raw",
    "cdr_mdt_smsng",
    "cdr_mdt_smsng_raw",
    "bts_master",
    "tbm_rpot_m",
    "tbm_gpot25",
    "tbm_bdri",
    "lte_call_fact",
    "contract_dim",
    "product_dim",
    "call_quality_iceberg",
    "call_quality_kudu",
)
TARGET_FILE_BYTES = 512 * 1024 * 1024
# values that one task sorts before it writes them
TASK_BYTES = 256 * 1024 * 1024


def analyze(spark: SparkSession, database: str = MAIN, tables: tuple[str, ...] = STATS_TABLES) -> None:
    """Refresh metadata and collect table and key-column statistics."""
    for name in tables:
        table = f"{database}.{name}"
        spec = TABLES[name]
        if spec.partition_column:
            spark.sql(f"MSCK REPAIR TABLE {table}")
        spark.sql(f"REFRESH TABLE {table}")
        spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")
        columns = [c for c in dict.fromkeys([spec.sort_by, spec.bucket_by, *spec.key]) if c]
        if columns:
            spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS FOR COLUMNS {', '.join(columns)}")


def analyze_partition(spark: SparkSession, table: str, value: str, database: str = MAIN) -> None:
    """Statistics of one newly loaded partition only."""
    column = TABLES[table].partition_column
    spark.sql(f"ANALYZE TABLE {database}.{table} PARTITION ({column}='{value}') COMPUTE STATISTICS")


def statistics(spark: SparkSession, database: str = MAIN, tables: tuple[str, ...] = STATS_TABLES) -> DataFrame:
    """What :func:`analyze` has stored: rows per table, and NULLs per key column (one row for a table without). Read from the catalog alone."""
    found = []
    for name in tables:
        spec = TABLES[name]
        stored = {r["col_name"]: r["data_type"] for r in describe(spark, name, database).collect()}.get("Statistics") or ""
        rows = next((int(part.split()[0]) for part in stored.split(", ") if part.endswith(" rows")), None)
        columns = [c for c in dict.fromkeys([spec.sort_by, spec.bucket_by, *spec.key]) if c]
        if not columns:
            found.append((name, rows, None, None))
        for column in columns:
            facts = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {database}.{name} {column}").collect()}
            nulls = facts.get("num_nulls")
            found.append((name, rows, column, int(nulls) if nulls not in (None, "NULL") else None))
    return spark.createDataFrame(found, "tbl string, row_cnt long, column_name string, null_cnt long")


def file_sizes(spark: SparkSession, path: str) -> DataFrame:
    """Files behind a stored table with their sizes. Only the listing is used, no file is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    return files.load(path).select(F.col("path").alias("file_path"), F.col("length").alias("file_size"))


def compact(spark: SparkSession, path: str, table: str, out: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """Rewrite a table to ``out`` in files of about ``target_bytes``, or of what one task sorts (TASK_BYTES of values), clustered on its
    sort column; returns the number of write tasks. The source stays readable."""
    source = read_table(spark, path, table)
    total = file_sizes(spark, path).agg(F.sum("file_size")).first()[0] or 0
    rows = source.select(*TABLES[table].schema.names)
    # files are compressed, and rows are sorted as they are in memory
    tasks = max(1, ceil(total / target_bytes), ceil(measured_bytes(rows) / TASK_BYTES))
    write_clustered(rows, out, table, tasks)
    return tasks


def partitions(spark: SparkSession, table: str, database: str = MAIN) -> DataFrame:
    return spark.sql(f"SHOW PARTITIONS {database}.{table}")


def describe(spark: SparkSession, table: str, database: str = MAIN) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {database}.{table}")


def list_tables(spark: SparkSession, database: str = MAIN) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}")
