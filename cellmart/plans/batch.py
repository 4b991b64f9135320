"""Daily batch transforms. ``days`` None runs every day at once.

Facts are summed per join key before they are joined. The sums are the same,
because every measure is additive over the joined rows, but only (day, key)
totals are shuffled, and a cell that holds a third of the day shrinks to one row
per task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellmart.functions.geo import flat_distance, flat_ends, with_segments
from cellmart.functions.predicates import LINE_CNT_METRES, SIGNALS, hour_key, on_days, trigger_rule
from cellmart.operators.grid_join import grid_join
from cellmart.operators.or_join import or_join_sums, or_weights
from cellmart.operators.sizing import dim_join, is_small, measured_bytes
from cellmart.session import stored

Days = str | Iterable[str] | None
# segments of a station's geometry that are columns of their own where every hit meets every station
FLAT = 2


def ltas_hourly(cdr: DataFrame, bts: DataFrame, etl: Days = None, base: Days = None) -> DataFrame:
    """Value and record count per day, hour and base station; unknown cells under NULL."""
    per_cell = (
        on_days(on_days(cdr, "etl_date", etl), "base_date", base)
        .groupBy("etl_date", hour_key("rqt_st_dt").alias("base_hour"), "cell_id")
        .agg(F.sum("val").alias("total_val"), F.count(F.lit(1)).alias("record_cnt"))
    )
    stations = bts.select("cell_id", "bts_alt_key", "region_cd")
    return (
        per_cell.join(stations, "cell_id", "left")
        .groupBy("etl_date", "base_hour", "bts_alt_key", "region_cd")
        .agg(F.sum("total_val").alias("total_val"), F.sum("record_cnt").alias("record_cnt"))
    )


def sgi_use_by_cell(cdr: DataFrame, bts: DataFrame, etl: Days = None, base: Days = None) -> DataFrame:
    """Used records per day and reported cell, counted once per station matching
    on either cell key and once when none does."""
    used = F.when(F.col("use_flag") == "Y", 1).otherwise(0)
    pairs = (
        on_days(on_days(cdr, "etl_date", etl), "base_date", base)
        .where(F.col("signal_type").isin(*SIGNALS))
        .groupBy("etl_date", "cell_id", "alt_cell_id")
        .agg(F.sum(used).alias("use_cnt"))
    )
    return or_join_sums(pairs, or_weights(bts, []), ["etl_date", "cell_id"], ["use_cnt"], [], "left")


def sgi_use_by_station(cdr: DataFrame, bts: DataFrame, etl: Days = None, base: Days = None) -> DataFrame:
    """Records per day and station matching on either cell key; a station without
    key is reported under the record's own cell."""
    pairs = (
        on_days(on_days(cdr, "etl_date", etl), "base_date", base)
        .groupBy("etl_date", "cell_id", "alt_cell_id")
        .agg(F.count(F.lit(1)).alias("use_cnt"))
    )
    with_key = or_weights(bts.where(F.col("bts_alt_key").isNotNull()), ["bts_alt_key"])
    without_key = or_weights(bts.where(F.col("bts_alt_key").isNull()), [])
    named = or_join_sums(pairs, with_key, ["etl_date"], ["use_cnt"], ["bts_alt_key"])
    unnamed = or_join_sums(pairs, without_key, ["etl_date", "cell_id"], ["use_cnt"], [])
    return (
        named.withColumnRenamed("bts_alt_key", "cell_id")
        .unionByName(unnamed)
        .groupBy("etl_date", "cell_id")
        .agg(F.sum("use_cnt").alias("use_cnt"))
    )


def mdt_merge(mdt: DataFrame, bts: DataFrame, rpot: DataFrame, base: Days = None) -> DataFrame:
    """Measurements close to a reporting line of their vendor, with the distance
    to every base station geometry of that vendor.

    The measurement is tested against the lines first; only hits meet the
    stations. As written, a measurement near k lines appears k times per station.
    Each hit becomes thousands of rows, so before that hits are dealt out evenly over all
    tasks, wherever the scan found them; if the stations are too many to broadcast and the hits
    are not, the stations are dealt out instead, and neither is repeated.
    """
    usable = (
        on_days(mdt, "base_date", base)
        .where(trigger_rule())
        .select("mdt_id", "gnss_utmkx", "gnss_utmky", "base_date", "bts_market_nm")
    )
    lines = with_segments(
        rpot.select(
            "bts_market_nm", "rpot_geom", (F.col("rpot_line_cnt").cast("long") * LINE_CNT_METRES).alias("reach")
        ),
        "rpot_geom",
    )
    hits = grid_join(usable, lines, ["bts_market_nm"], "gnss_utmkx", "gnss_utmky").drop("reach")
    tasks = int(mdt.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = bts.select("bts_market_nm", "bts_alt_key", "rpot_geom").repartition(tasks)
    parsed = with_segments(dealt, "rpot_geom", "segs")
    stations = stored(parsed.withColumns(flat_ends(F.col("segs"), "segs", FLAT)), "stations")
    size = measured_bytes(stations)
    if not is_small(size):
        hits = stored(hits, "hits")
    if not is_small(size) and is_small(measured_bytes(hits)):
        met = stations.repartition(tasks).join(F.broadcast(hits), "bts_market_nm")
    else:
        met = dim_join(hits.repartition(tasks), stations, ["bts_market_nm"], "inner", size=size)
    return met.select(
        "mdt_id",
        "gnss_utmkx",
        "gnss_utmky",
        "bts_alt_key",
        flat_distance(F.col("gnss_utmkx"), F.col("gnss_utmky"), "segs", FLAT).alias("distance_m"),
        "base_date",
    )


def stamped(df: DataFrame, column: str = "created_at") -> DataFrame:
    """Add the load time the stored result tables carry."""
    return df.withColumn(column, F.current_timestamp())
