"""Filters, keys and measures shared by batch and streaming jobs."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Domains and thresholds of the data model.
SIGNALS = ("S1AP", "SGI")
USE_FLAGS = ("Y", "N")
MARKETS = ("SAMSUNG", "ERICSSON", "NOKIA")
RSRP_BANDS = ("1550", "1650", "1694", "1700")
RSRP_GOOD, RSRP_BAD = -75, -110
LINE_CNT_METRES = 3
TRIGGERS = {"ERICSSON": "PERIODIC", "NOKIA": None, "SAMSUNG": ""}
TIME_KEY, DATE_KEY = "yyyyMMddHHmmss", "yyyyMMdd"


def on_days(df: DataFrame, column: str, days: str | Iterable[str] | None) -> DataFrame:
    """Keep one day, several days or, with None, everything; a plain column
    comparison, so it prunes partitions."""
    if days is None:
        return df
    if isinstance(days, str):
        return df.where(F.col(column) == days)
    return df.where(F.col(column).isin(list(days)))


def minute_is(column: str, minute: str) -> Column:
    return F.substring(column, 11, 2) == minute


def hour_key(column: str) -> Column:
    return F.substring(column, 1, 10)


def key_time(column: str) -> Column:
    """A ``YYYYMMDDHHmm..`` text key as a time, NULL if it is none.

    Spelled out and cast, which is far cheaper than parsing with a pattern.
    """

    def part(start: int, width: int = 2) -> Column:
        return F.substring(column, start, width)

    day = F.concat_ws("-", part(1, 4), part(5), part(7))
    return F.concat(day, F.lit(" "), part(9), F.lit(":"), part(11), F.lit(":00")).try_cast("timestamp")


def trigger_rule() -> Column:
    """Which trigger value each vendor reports for a usable measurement.

    An empty string and NULL are different values here.
    """
    rules = [
        (F.col("bts_market_nm") == market) & F.col("trigr_ev").eqNullSafe(F.lit(trigger))
        for market, trigger in TRIGGERS.items()
    ]
    return reduce(Column.__or__, rules)


def hit_count(condition: Column) -> Column:
    """Number of rows meeting a condition, NULL when there is none."""
    return F.sum(F.when(condition, 1))


def ratio(part: Column, whole: Column) -> Column:
    return part.cast("double") / F.nullif(whole, F.lit(0))
