"""Conforming raw records: keys, domains, ranges, time keys and row ids.

Replacement values are chosen by a hash of the record id, so a rerun repairs a
record the same way.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.functions.predicates import DATE_KEY, MARKETS, SIGNALS, TIME_KEY, USE_FLAGS, minute_is
from cellmart.operators.numbering import row_index
from cellmart.operators.sizing import dim_join, measured_bytes

# Ranges, defaults and the region list.
VAL_DEFAULT, VAL_LOW, VAL_HIGH = 0, 0, 10_000_000
X_DEFAULT, X_LOW, X_HIGH = 961_000.0, 900_000.0, 1_100_000.0
Y_DEFAULT, Y_LOW, Y_HIGH = 1_946_000.0, 1_900_000.0, 2_100_000.0
REGIONS = (
    "SEOUL",
    "BUSAN",
    "DAEGU",
    "INCHEON",
    "GWANGJU",
    "DAEJEON",
    "ULSAN",
    "SUWON",
    "JEJU",
    "CHANGWON",
)


def pick(record_id: Column, choices: int) -> Column:
    """A stable choice 0..choices-1 from a record id."""
    digest = F.md5(F.coalesce(record_id, F.lit("")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(choices))


def repair_keys(cdr: DataFrame, bts: DataFrame, record_id: str = "sgi_id") -> DataFrame:
    """Replace cell ids missing from the dimension and take the alternate cell from it."""
    stations = (
        bts.where(F.col("cell_id").isNotNull())
        .groupBy("cell_id")
        .agg(F.max("alt_cell_id").alias("_alt"))
    )
    indexed, count = row_index(stations, "_index", ["cell_id"])
    if count == 0:
        raise ValueError("the station dimension is empty")
    known = indexed.select("cell_id", "_alt", F.lit(True).alias("_known"))
    substitutes = indexed.select(
        F.col("_index").alias("_pick"), F.col("cell_id").alias("_new_cell"), F.col("_alt").alias("_new_alt")
    )
    size = measured_bytes(known)
    marked = dim_join(cdr, known, ["cell_id"], "left", size=size).withColumn(
        "_pick", F.when(F.col("_known").isNull(), pick(F.col(record_id), count))
    )
    repaired = dim_join(marked, substitutes, ["_pick"], "left", size=size)
    values = {
        "cell_id": F.coalesce("_new_cell", "cell_id"),
        "alt_cell_id": F.coalesce("_new_alt", "_alt", "alt_cell_id"),
    }
    return repaired.select(*[values.get(c, F.col(c)).alias(c) for c in cdr.columns])


def repair_domain(df: DataFrame, column: str, domain: Sequence[str], record_id: str) -> DataFrame:
    """Replace values outside a short list, NULL included."""
    listed = F.coalesce(F.col(column).isin(*domain), F.lit(False))
    position = (pick(F.col(record_id), len(domain)) + 1).cast("int")
    substitute = F.element_at(F.array(*[F.lit(v) for v in domain]), position)
    return df.withColumn(column, F.when(listed, F.col(column)).otherwise(substitute))


def clip_fill(df: DataFrame, column: str, default: float, low: float, high: float) -> DataFrame:
    """Default for missing values (NULL or NaN), then limits; the column type stays."""
    kind = df.schema[column].dataType
    value = F.col(column)
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        value = F.when(~F.isnan(value), value)
    filled = F.coalesce(value, F.lit(default).cast(kind))
    return df.withColumn(column, F.least(F.greatest(filled, F.lit(low).cast(kind)), F.lit(high).cast(kind)))


def time_keys(df: DataFrame) -> DataFrame:
    """Day and second keys as text, from the event time."""
    return df.withColumns(
        {"etl_date": F.date_format("event_time", DATE_KEY), "rqt_st_dt": F.date_format("event_time", TIME_KEY)}
    )


def row_ids(df: DataFrame, column: str, prefix: str, order_by: Sequence[str] | None = None) -> DataFrame:
    """Surrogate ids: prefix and a dense twelve-digit number from 0."""
    indexed, _ = row_index(df.drop(column), "_n", order_by)
    return indexed.withColumn(column, F.format_string(f"{prefix}%012d", "_n")).select(*df.columns)


def stations_from_index(index: DataFrame, column: str = "i") -> DataFrame:
    """Station rows numbered by ``column``, regions and vendors in rotation."""
    i = F.col(column)

    def rotate(values: Sequence[str]) -> Column:
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(i, F.lit(len(values))) + 1).cast("int"))

    cell = F.format_string("CELL_%06d", i)
    return index.select(
        cell.alias("cell_id"),
        F.concat(cell, F.lit("_ALT")).alias("alt_cell_id"),
        F.concat(F.lit("BTS_"), rotate(REGIONS), F.format_string("_%04d", i)).alias("bts_alt_key"),
        rotate(MARKETS).alias("bts_market_nm"),
        rotate(REGIONS).alias("region_cd"),
    )


def expand_stations(spark: SparkSession, seed: DataFrame, rows: int) -> DataFrame:
    """``rows`` stations: the first seed rows by cell while they suffice, else generated ones."""
    indexed, available = row_index(seed, "_n", ["cell_id"])
    if rows <= available:
        return indexed.where(F.col("_n") < rows).drop("_n")
    return stations_from_index(spark.range(rows).withColumnRenamed("id", "i"))


def conform_cdr(cdr: DataFrame, bts: DataFrame, order_by: Sequence[str] | None = None) -> DataFrame:
    """All rules for call records, in the order the repairs depend on each other."""
    out = time_keys(repair_keys(cdr, bts))
    out = clip_fill(out, "val", VAL_DEFAULT, VAL_LOW, VAL_HIGH)
    out = repair_domain(out, "use_flag", USE_FLAGS, "sgi_id")
    out = repair_domain(out, "signal_type", SIGNALS, "sgi_id")
    return row_ids(out, "sgi_id", "SGI", order_by)


def conform_mdt(mdt: DataFrame, markets: Sequence[str] = MARKETS, order_by: Sequence[str] | None = None) -> DataFrame:
    """All rules for handset measurements."""
    out = repair_domain(mdt, "bts_market_nm", markets, "mdt_id")
    out = clip_fill(out, "gnss_utmkx", X_DEFAULT, X_LOW, X_HIGH)
    out = clip_fill(out, "gnss_utmky", Y_DEFAULT, Y_LOW, Y_HIGH)
    return row_ids(out, "mdt_id", "MDT", order_by)


def load_summary(tables: dict[str, DataFrame], minute: str = "45") -> DataFrame:
    """Rows per table, and rows passing the minute filter where a table has a second key."""
    parts = []
    for name, df in tables.items():
        eligible = (
            F.sum(F.when(minute_is("rqt_st_dt", minute), 1).otherwise(0)) if "rqt_st_dt" in df.columns else F.lit(None)
        )
        parts.append(
            df.agg(F.count(F.lit(1)).alias("row_cnt"), eligible.cast("long").alias("filter_pass_cnt")).select(
                F.lit(name).alias("tbl"), "row_cnt", "filter_pass_cnt"
            )
        )
    return reduce(DataFrame.unionByName, parts)
