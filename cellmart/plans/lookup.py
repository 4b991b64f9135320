"""Key lookups on bucketed and partitioned tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellmart.operators.sizing import is_small, measured_bytes
from cellmart.schemas import schema
from cellmart.session import stored

QUALITY = schema("call_quality_kudu").names
# how often one row of the key list may stand for a key
BLOCK = 4096
BY_CALL = schema("call_quality_kudu_by_call").names


def by_key(table: DataFrame, key: str) -> DataFrame:
    """One key; on a bucketed table one bucket is read."""
    return table.where(F.col("lookup_key") == key).select(*QUALITY)


def by_key_and_date(table: DataFrame, key: str, base_date: str) -> DataFrame:
    """One key within one date partition."""
    return table.where((F.col("lookup_key") == key) & (F.col("base_date") == base_date)).select(*QUALITY)


def by_other_key(table: DataFrame, **wanted: str) -> DataFrame:
    """Rows with the wanted values in columns that the table is not laid out by; its Bloom filters tell which row groups may hold them."""
    return table.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in wanted.items()])).select(*QUALITY)


def by_call(table: DataFrame, call_id: str, first: str, last: str) -> DataFrame:
    """One call over a date range, on the table keyed by call."""
    return table.where((F.col("call_id") == call_id) & F.col("base_date").between(first, last)).select(*BY_CALL)


def by_keys(table: DataFrame, keys: DataFrame) -> DataFrame:
    """A whole key list in one job: every listed key with its row and ``found``.

    The list is reduced once to its distinct keys with their counts. While these are few they are sent to the table, so it
    is not shuffled for a list of moderate size; beyond that the table and the list are moved once each. Keys and rows meet
    one to one, and only the result repeats a row as often as the list has its key, in blocks that are dealt out.
    """
    # stored, since it is measured and read up to twice
    counted = stored(keys.groupBy("lookup_key").agg(F.count(F.lit(1)).alias("_n")), "asked")
    asked = counted.select("lookup_key").where(F.col("lookup_key").isNotNull())
    hits = table.select(*QUALITY)
    if is_small(measured_bytes(asked)):
        hits = hits.join(F.broadcast(asked), "lookup_key", "left_semi")
    # one row of a key for every BLOCK times it is listed
    last = F.floor((F.col("_n") - 1) / BLOCK)
    blocks = counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    blocks = blocks.withColumn("_times", F.least(F.lit(BLOCK), F.col("_n") - F.col("_block") * BLOCK).cast("int"))
    return (
        blocks.join(hits.withColumn("_hit", F.lit(True)), "lookup_key", "left")
        .withColumn("found", F.coalesce("_hit", F.lit(False)))
        .withColumn("_time", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*QUALITY, "found")
    )


def quality_by_call(quality: DataFrame) -> DataFrame:
    """Rows of the secondary table: one per (call, day), the greatest key winning."""
    rest = ["lookup_key", "rsrp", "drop_flag"]
    return (
        quality.groupBy("call_id", "base_date")
        .agg(F.max(F.struct(*rest)).alias("_row"))
        .select("call_id", "base_date", "_row.*")
        .select(*BY_CALL)
    )
