"""Audits of loads, streams and response times, each as one small result table."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cellmart.functions.predicates import minute_is
from cellmart.operators.numbering import exact_quantiles
from cellmart.operators.sizing import dim_join
from cellmart.session import stored

WINDOW_SECONDS = 300
SINK_COLUMNS = {
    "window_start": "timestamp",
    "window_end": "timestamp",
    "bts_alt_key": "string",
    "region_cd": "string",
    "total_val": "bigint",
    "record_cnt": "bigint",
}


def row_count_audit(tables: dict[str, DataFrame], expected: DataFrame) -> DataFrame:
    """Row counts against expected ones (``tbl``, ``expected``): ok, mismatch, or
    pending while nothing is expected yet."""
    counts = reduce(
        DataFrame.unionByName,
        [
            df.agg(F.count(F.lit(1)).alias("cnt")).select(F.lit(name).alias("tbl"), "cnt")
            for name, df in tables.items()
        ],
    )
    status = (
        F.when(F.col("expected").isNull(), "pending")
        .when(F.col("cnt") == F.col("expected"), "ok")
        .otherwise("mismatch")
    )
    return counts.join(expected, "tbl", "left").select("tbl", "cnt", "expected", status.alias("status"))


def eligible_counts(sources: dict[str, DataFrame], minute: str = "45") -> DataFrame:
    """Rows per source passing the minute filter."""
    return reduce(
        DataFrame.unionByName,
        [
            df.where(minute_is("rqt_st_dt", minute))
            .agg(F.count(F.lit(1)).alias("cnt"))
            .select(F.lit(name).alias("tbl"), "cnt")
            for name, df in sources.items()
        ],
    )


def parity(batch: DataFrame, stream: DataFrame, on: list[str], values: list[str]) -> DataFrame:
    """Batch and stream results side by side per key, with a difference per value.

    A key missing on one side has NULL there and counts as zero in the difference.
    Keys compare NULL-safe: records without a station form a group too.
    """
    left = batch.select(*[F.col(c).alias(f"b_{c}") for c in [*on, *values]], F.lit(True).alias("_b"))
    right = stream.select(*[F.col(c).alias(f"s_{c}") for c in [*on, *values]], F.lit(True).alias("_s"))
    same = reduce(lambda a, b: a & b, [F.col(f"b_{c}").eqNullSafe(F.col(f"s_{c}")) for c in on])
    zero = F.lit(0)
    return left.join(right, same, "full_outer").select(
        *[F.when(F.col("_b"), F.col(f"b_{c}")).otherwise(F.col(f"s_{c}")).alias(c) for c in on],
        *[F.col(f"b_{v}").alias(f"batch_{v}") for v in values],
        *[F.col(f"s_{v}").alias(f"stream_{v}") for v in values],
        *[(F.coalesce(f"s_{v}", zero) - F.coalesce(f"b_{v}", zero)).alias(f"diff_{v}") for v in values],
        F.when(F.col("_b") & F.col("_s"), "both").when(F.col("_b"), "batch").otherwise("stream").alias("side"),
    )


def _digests(rows: DataFrame, by: list[str], on: list[str], values: list[str], side: str) -> DataFrame:
    """Per group: how many rows, and two order-free digests of them, summed in the scan tasks."""
    row = F.xxhash64(*[F.col(c) for c in [*on, *values]])
    # halves of the hash, so that a sum of very many fits a long
    low, high = row.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(row, 32)
    sums = {"n": F.count(F.lit(1)), "low": F.sum(low), "high": F.sum(high), "bits": F.bit_xor(row)}
    return rows.groupBy(*by).agg(*[v.alias(f"{side}_{k}") for k, v in sums.items()])


def _differing(left: DataFrame, right: DataFrame, by: list[str], on: list[str], values: list[str]) -> DataFrame:
    a, b = _digests(left, by, on, values, "b"), _digests(right, by, on, values, "s")
    b = b.withColumnsRenamed({c: f"_{c}" for c in by})
    both = a.join(b, reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]), "full_outer")
    same = reduce(lambda x, y: x & y, [F.col(f"b_{k}").eqNullSafe(F.col(f"s_{k}")) for k in ("n", "low", "high", "bits")])
    here = F.col("b_n").isNotNull()
    return both.where(~same).select(*[F.when(here, F.col(c)).otherwise(F.col(f"_{c}")).alias(c) for c in by])


def parity_digests(
    batch: DataFrame, stream: DataFrame, on: list[str], values: list[str], at: str = "window_start"
) -> DataFrame:
    """:func:`parity` of the keys that differ only, found from digests: days first, then windows of the days that differ.

    Count, sums and exclusive or of row hashes do not depend on order and are summed in the scan tasks, so of equal days one row each
    is moved; only rows of differing windows meet key by key. Two sides that differ escape with a chance of about 2^-128.
    """
    day = F.to_date(at).alias("_day")

    def placed(rows: DataFrame) -> DataFrame:
        return rows.select("*", day)

    left, right = placed(batch), placed(stream)
    days = stored(_differing(left, right, ["_day"], on, values), "days")

    def within(rows: DataFrame, found: DataFrame, by: str) -> DataFrame:
        return rows.join(F.broadcast(found.withColumnRenamed(by, "_by")), F.col(by).eqNullSafe(F.col("_by")), "left_semi")

    left, right = (within(x, days, "_day") for x in (left, right))
    spans = stored(_differing(left, right, [at], on, values), "windows")

    def chosen(rows: DataFrame) -> DataFrame:
        marked = dim_join(rows, spans.withColumn("_hit", F.lit(True)), [at], "inner", null_safe=True)
        return marked.drop("_hit", "_day")

    found = parity(chosen(left), chosen(right), on, values)
    differs = reduce(lambda x, y: x | y, [F.col("side") != "both", *[~F.col(f"batch_{v}").eqNullSafe(F.col(f"stream_{v}")) for v in values]])
    return found.where(differs)


def parity_summary(label: str, compared: DataFrame, value: str = "record_cnt") -> DataFrame:
    """One line per job: totals of both sides, their difference and the keys that differ."""
    differs = (F.col("side") != "both") | (F.col(f"diff_{value}") != 0)
    return compared.agg(
        F.coalesce(F.sum(f"batch_{value}"), F.lit(0)).alias("batch_count"),
        F.coalesce(F.sum(f"stream_{value}"), F.lit(0)).alias("stream_count"),
        F.coalesce(F.sum(f"diff_{value}"), F.lit(0)).alias("diff"),
        F.coalesce(F.sum(F.when(differs, 1).otherwise(0)), F.lit(0)).alias("differing_keys"),
    ).select(F.lit(label).alias("job"), "batch_count", "stream_count", "diff", "differing_keys")


def parity_counts(label: str, batch: DataFrame, sink: DataFrame, window_start: dt.datetime) -> DataFrame:
    """The coarse check: rows of a daily result against records of one stream window.

    The two numbers measure different things; :func:`parity` is the sound check.
    """
    none = F.lit(None).cast("long")
    daily = batch.agg(F.count(F.lit(1)).alias("batch_count")).select("batch_count", none.alias("stream_count"))
    window = (
        sink.where(F.col("window_start") == F.lit(window_start))
        .agg(F.sum("record_cnt").alias("stream_count"))
        .select(none.alias("batch_count"), "stream_count")
    )
    return (
        daily.unionByName(window)
        .agg(F.max("batch_count").alias("batch_count"), F.max("stream_count").alias("stream_count"))
        .select(
            F.lit(label).alias("job"),
            "batch_count",
            "stream_count",
            (F.col("stream_count") - F.col("batch_count")).alias("diff"),
        )
    )


def latest_windows(sinks: dict[str, DataFrame], n: int = 10) -> DataFrame:
    """The newest ``n`` rows of every sink, columns a sink lacks as NULL."""
    parts = []
    for name, df in sinks.items():
        rows = df.select(
            F.lit(name).alias("tbl"),
            *[
                (F.col(c) if c in df.columns else F.lit(None).cast(kind)).alias(c)
                for c, kind in SINK_COLUMNS.items()
            ],
        )
        parts.append(
            rows.orderBy(
                F.desc("window_start"), F.asc_nulls_last("bts_alt_key"), F.asc_nulls_last("region_cd")
            ).limit(n)
        )
    return reduce(DataFrame.unionByName, parts)


def window_violations(sink: DataFrame) -> DataFrame:
    """Sink rows whose window is not an aligned five minutes."""
    start, end = F.unix_timestamp("window_start"), F.unix_timestamp("window_end")
    return sink.where((end - start != WINDOW_SECONDS) | (F.pmod(start, F.lit(WINDOW_SECONDS)) != 0))


def filter_violations(sink: DataFrame, source: DataFrame, minute: str = "45") -> DataFrame:
    """Sink windows in which the source has no row passing the minute filter."""
    eligible = (
        source.where(minute_is("rqt_st_dt", minute))
        .select(F.window("event_time", "5 minutes")["start"].alias("window_start"))
        .distinct()
    )
    return sink.join(eligible, "window_start", "left_anti")


def latency_summary(timings: DataFrame, group: str = "engine", value: str = "elapsed_sec") -> DataFrame:
    """Average, maximum, count and exact 95th/99th percentile; failed runs (-1) excluded."""
    valid = timings.where(F.col(value) >= 0)
    basic = valid.groupBy(group).agg(
        F.avg(value).alias("avg_sec"), F.max(value).alias("max_sec"), F.count(F.lit(1)).alias("n")
    )
    ranks = exact_quantiles(valid, [group], value, {"p95_sec": 0.95, "p99_sec": 0.99})
    same = F.col(group).eqNullSafe(F.col("_group"))
    return basic.join(ranks.withColumnRenamed(group, "_group"), same).drop("_group")


def latency_alerts(
    timings: DataFrame,
    group: str = "engine",
    value: str = "elapsed_sec",
    at: str = "started_at",
    limit: float = 3.0,
    run: int = 5,
    every: str = "1 minute",
) -> DataFrame:
    """Stretches of at least ``run`` consecutive intervals whose 95th percentile exceeds ``limit``."""
    seconds = _interval_seconds(every)
    valid = timings.where(F.col(value) >= 0).withColumn("_slot", F.window(at, every)["start"])
    p95 = exact_quantiles(valid, [group, "_slot"], value, {"p95_sec": 0.95})
    # one row per interval: consecutive slots minus their rank are equal
    along = Window.partitionBy(group).orderBy("_slot")
    slots = p95.where(F.col("p95_sec") > limit).withColumn(
        "_run", F.floor(F.unix_timestamp("_slot") / F.lit(seconds)) - F.row_number().over(along)
    )
    return (
        slots.groupBy(group, "_run")
        .agg(
            F.min("_slot").alias("first_slot"),
            F.max("_slot").alias("last_slot"),
            F.count(F.lit(1)).alias("slots"),
            F.max("p95_sec").alias("worst_p95_sec"),
        )
        .where(F.col("slots") >= run)
        .drop("_run")
    )


def _interval_seconds(every: str) -> int:
    count, unit = every.split()
    return int(count) * {"second": 1, "minute": 60, "hour": 3600, "day": 86400}[unit.rstrip("s")]


def recent_history(
    log: DataFrame, now: dt.datetime, started: str = "start_time", tie: str = "query_id", hours: int = 24, n: int = 50
) -> DataFrame:
    """The newest ``n`` log rows of the last ``hours``, with the duration in seconds."""
    since = F.lit(now - dt.timedelta(hours=hours))
    return (
        log.where(F.col(started) > since)
        .withColumn("duration_sec", F.col("duration_ms") / 1000)
        .orderBy(F.desc(started), tie)
        .limit(n)
        .drop("duration_ms")
    )


def time_range(tables: dict[str, DataFrame], column: str = "event_time") -> DataFrame:
    """First and last event per table."""
    return reduce(
        DataFrame.unionByName,
        [
            df.agg(F.min(column).alias("min_time"), F.max(column).alias("max_time")).select(
                F.lit(name).alias("tbl"), "min_time", "max_time"
            )
            for name, df in tables.items()
        ],
    )
