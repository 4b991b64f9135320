"""Dashboard queries and the two result marts."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.functions.predicates import (
    RSRP_BAD,
    RSRP_BANDS,
    RSRP_GOOD,
    hit_count,
    key_time,
    on_days,
    ratio,
)
from cellmart.operators.sizing import dim_join

Days = str | Iterable[str] | None
AREA = ["sido_name", "gungu_name", "bemd_name", "bdri_name"]


def rsrp_bad_rate(
    mdt: DataFrame, gpot: DataFrame, bdri: DataFrame, month: str | None = None, keep: list[str] | None = None
) -> DataFrame:
    """Signal strength counts per administrative area, for a date prefix or all dates.

    Measurements are counted per map cell before the map cell is joined to its area.
    """
    keep = keep or []
    band, rsrp = F.col("dlearfcn_cd").isin(*RSRP_BANDS), F.col("rsrp")
    measures = {
        "rsrp_18_o75": hit_count(band & (rsrp > RSRP_GOOD)),
        "rsrp_18_u110": hit_count(band & (rsrp <= RSRP_BAD)),
        "rsrp_18_tot": hit_count(band),
        "rsrp_o75": hit_count(rsrp > RSRP_GOOD),
        "rsrp_u110": hit_count(rsrp <= RSRP_BAD),
        "rsrp_tot": F.count(F.lit(1)),
    }
    if month is not None:
        mdt = mdt.where(F.col("base_date").startswith(month))
    per_cell = mdt.groupBy("gnss_metric_id", *keep).agg(*[m.alias(n) for n, m in measures.items()])

    def part(n: int) -> Column:
        return F.split_part(F.col("gnss_metric_id"), F.lit("_"), F.lit(n))

    located = per_cell.withColumn("gx", part(1)).withColumn("gy", part(2))
    cells = gpot.select(
        F.col("gpot25_x").cast("string").alias("gx"), F.col("gpot25_y").cast("string").alias("gy"), "bdri_cd"
    )
    return (
        located.join(cells, ["gx", "gy"])
        .join(bdri, "bdri_cd")
        .groupBy(*keep, *AREA)
        .agg(*[F.sum(n).alias(n) for n in measures])
    )


def volte_parts(
    calls: DataFrame,
    contracts: DataFrame,
    products: DataFrame,
    base: Days = None,
    by: Column | None = None,
) -> DataFrame:
    """Calls, dropped and all voice calls on eligible products per ``period``: the day, or
    another expression over the calls. Sums over parts of the calls add up.

    Both dimensions take part as row counts per key: a repeated contract or
    product multiplies the calls, as in the plain star join, without building
    the joined rows.
    """
    period = F.col("base_date") if by is None else by
    eligible = (
        products.where(F.col("volte_eligible") == "Y").groupBy("product_id").agg(F.count(F.lit(1)).alias("copies"))
    )
    volte = F.col("volte_flag") == "Y"
    dropped = (F.col("drop_flag") == "Y") & volte
    per_contract = (
        dim_join(on_days(calls, "base_date", base), eligible, ["product_id"], "inner")
        .groupBy("contract_id", period.alias("_period"))
        .agg(
            F.sum("copies").alias("total_calls"),
            F.sum(F.when(dropped, F.col("copies")).otherwise(0)).alias("dropped_volte"),
            F.sum(F.when(volte, F.col("copies")).otherwise(0)).alias("volte_calls"),
        )
    )
    weights = contracts.groupBy("contract_id").agg(F.count(F.lit(1)).alias("weight"))
    return (
        per_contract.join(weights, "contract_id")
        .groupBy(F.col("_period").alias("period"))
        .agg(
            *[
                F.sum(F.col(c) * F.col("weight")).alias(c)
                for c in ("total_calls", "dropped_volte", "volte_calls")
            ]
        )
    )


def volte_drop(
    calls: DataFrame,
    contracts: DataFrame,
    products: DataFrame,
    base: Days = None,
    by: Column | None = None,
) -> DataFrame:
    """Calls, dropped voice calls and their rate on eligible products, per day or
    per another expression over the calls, named ``period``; see :func:`volte_parts`."""
    totals = volte_parts(calls, contracts, products, base, by)
    return totals.select(
        F.col("period").alias("base_date" if by is None else "period"),
        "total_calls",
        "dropped_volte",
        ratio(F.col("dropped_volte"), F.col("volte_calls")).alias("volte_drop_rate"),
    )


def partition_count(cdr: DataFrame, query_id: str, etl: Days = None, base: Days = None) -> DataFrame:
    """Tagged row count of the selected days; always one row."""
    rows = on_days(on_days(cdr, "etl_date", etl), "base_date", base)
    return rows.agg(F.count(F.lit(1)).alias("row_cnt")).select(F.lit(query_id).alias("query_id"), "row_cnt")


def region_total(cdr: DataFrame, bts: DataFrame, query_id: str, etl: Days = None) -> DataFrame:
    """Tagged value per region."""
    per_cell = on_days(cdr, "etl_date", etl).groupBy("cell_id").agg(F.sum("val").alias("total_val"))
    return (
        per_cell.join(bts.select("cell_id", "region_cd"), "cell_id")
        .groupBy("region_cd")
        .agg(F.sum("total_val").alias("total_val"))
        .select(F.lit(query_id).alias("query_id"), "region_cd", "total_val")
    )


def mart_rsrp(mdt: DataFrame, gpot: DataFrame, bdri: DataFrame, run_id: str, month: str | None = None) -> DataFrame:
    """Daily signal counts per province and district, for the stored mart."""
    daily = rsrp_bad_rate(mdt, gpot, bdri, month, keep=["base_date"])
    return (
        daily.groupBy("base_date", "sido_name", "gungu_name")
        .agg(F.sum("rsrp_tot").alias("rsrp_tot"), F.sum("rsrp_u110").alias("rsrp_u110"))
        .select(
            F.lit(run_id).alias("run_id"), "base_date", "sido_name", "gungu_name", "rsrp_tot", "rsrp_u110"
        )
    )


def five_minutes() -> Column:
    """The start of the five minutes of a call as text, to be turned into a time once per result row."""
    minute = F.substring("call_start_dt", 11, 2).try_cast("int")
    return F.concat(F.substring("call_start_dt", 1, 10), F.lpad((minute - minute % 5).cast("string"), 2, "0"))


def mart_volte(
    calls: DataFrame, contracts: DataFrame, products: DataFrame, run_id: str, base: Days = None
) -> DataFrame:
    """Voice drop rate per five minutes of call start, for the stored mart; calls
    without a readable start come under NULL."""
    rates = volte_drop(calls, contracts, products, base, by=five_minutes())
    return rates.select(
        F.lit(run_id).alias("run_id"),
        key_time("period").alias("window_start"),
        F.col("volte_drop_rate").alias("drop_rate"),
        "total_calls",
        F.col("dropped_volte").alias("dropped_calls"),
    )
