"""Dated stations under the window jobs: sums per stretch between changes against every record met by every version."""

import datetime as dt
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cellmart.operators import pit_sums, sizing
from cellmart.operators.pit_join import with_validity
from cellmart.streaming import windows

BASE = dt.datetime(2025, 12, 1, 23, 50)
VERSION = "cell_id string, alt_cell_id string, bts_market_nm string, bts_alt_key string, region_cd string, valid_from timestamp"
RECORD = "cell_id string, alt_cell_id string, rqt_st_dt string, signal_type string, use_flag string, val long, event_time timestamp"


def at(seconds):
    return BASE + dt.timedelta(seconds=seconds)


def some_versions(rng, n, span=4000):
    """Starts in a few minutes around the records, some at window borders, some days or years before; open and replaced."""
    rows = []
    for i in range(n):
        cell = rng.choice(["a", "b", "c", "d", None])
        when = rng.choice([rng.randrange(-span, span), 300 * rng.randrange(-10, 10), -86400 * rng.randrange(1, 900)])
        rows.append((cell, rng.choice(["x", "y", None]), rng.choice(["S", "E", None]), f"bts{i % 7}", rng.choice(["r1", None]), at(when)))
    seen = set()
    return [r for r in rows if (r[0], r[5]) not in seen and not seen.add((r[0], r[5]))]


def some_records(rng, n, span=2400):
    return [
        (
            rng.choice(["a", "b", "c", "zz", None]), rng.choice(["x", "y", "zz", None]), "20251201004500",
            rng.choice(["S1AP", "SGI", "other"]), rng.choice(["Y", "N", None]), rng.randrange(100), at(rng.choice([rng.randrange(-span, span), 300 * rng.randrange(-5, 5)])),
        )
        for _ in range(n)
    ]


def dated_rows(spark, rows):
    dated = with_validity(spark.createDataFrame(rows, VERSION), "cell_id")
    return dated, [tuple(r) for r in dated.collect()]


def in_force(v, moment):
    return v[5] <= moment and (v[6] is None or moment < v[6])


def window_of(moment):
    return moment - dt.timedelta(minutes=moment.minute % 5, seconds=moment.second)


@pytest.mark.parametrize("seed", [1, 2])
def test_either_key_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    versions, plain = dated_rows(spark, some_versions(rng, 80))
    records = some_records(rng, 400)
    expected = defaultdict(lambda: [0, 0])
    for cell, alt, _, kind, used, val, moment in records:
        if kind == "other":
            continue
        met = [v for v in plain if in_force(v, moment) and ((cell is not None and v[0] == cell) or (alt is not None and v[1] == alt))]
        for v in met or [(None,) * 7]:
            sums = expected[(window_of(moment), v[3], v[4])]
            sums[0] += val if used == "Y" else 0
            sums[1] += 1
    got = windows.sgi_v1_versioned(spark.createDataFrame(records, RECORD), versions).collect()
    assert {(r.window_start, r.bts_alt_key, r.region_cd): [r.total_val, r.record_cnt] for r in got} == dict(expected)
    assert len(got) == len(expected) > 50 and any(k[1] is None for k in expected)


@pytest.mark.parametrize("seed", [3, 4])
def test_vendor_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    versions, plain = dated_rows(spark, some_versions(rng, 80))
    moments = [(rng.choice(["S", "E", "N", None]), "20251201004500", at(rng.randrange(-2400, 2400))) for _ in range(300)]
    expected = Counter()
    for vendor, _, moment in moments:
        met = [v for v in plain if vendor is not None and v[2] == vendor and in_force(v, moment)]
        expected.update((window_of(moment), v[3]) for v in met or [(None,) * 7])
    got = windows.mdt_versioned(spark.createDataFrame(moments, "bts_market_nm string, rqt_st_dt string, event_time timestamp"), versions).collect()
    assert {(r.window_start, r.bts_alt_key): r.record_cnt for r in got} == dict(expected)


def test_coverage_joins_versions_that_follow_each_other(spark, bag):
    rows = [("a", 0, 10), ("a", 10, 20), ("a", 15, 18), ("a", 30, None), ("b", 5, 5), ("c", 86400 * 3, 86400 * 9), ("c", 86400 * 2, 86400 * 3), (None, 0, 1)]
    made = [(k, at(s), None if e is None else at(e)) for k, s, e in rows]
    versions = spark.createDataFrame(made, "cell_id string, valid_from timestamp, valid_to timestamp")
    got = pit_sums.coverage(versions, "cell_id", "known").select("cell_id", "valid_from", "valid_to").collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(
        [("a", at(0), at(20)), ("a", at(30), None), ("c", at(86400 * 2), at(86400 * 9))], key=repr
    )


def test_empty_tables(spark):
    versions, plain = dated_rows(spark, some_versions(random.Random(5), 20))
    records = spark.createDataFrame(some_records(random.Random(5), 20), RECORD)
    assert windows.sgi_v1_versioned(records.limit(0), versions).collect() == []
    got = windows.sgi_v1_versioned(records, versions.limit(0)).collect()
    assert all(r.bts_alt_key is None for r in got)
    assert sum(r.record_cnt for r in got) == records.where("signal_type <> 'other'").count()


def test_rows_follow_changes_and_stations_not_records(spark, plan):
    """Very many records of one vendor in one window, 300 stations, four changes: no join makes records times stations."""
    stations = [(f"c{i}", None, "S", f"bts{i}", None, at(-86400)) for i in range(300)] + [(f"c{i}", None, "S", f"new{i}", None, at(60 * i + 7)) for i in range(4)]
    versions, _ = dated_rows(spark, stations)
    records = spark.range(200_000).select(
        F.substring(F.concat(F.lit("S"), "id"), 1, 1).alias("bts_market_nm"), F.lit("20251201004500").alias("rqt_st_dt"),
        (F.lit(BASE).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 300).cast("decimal(18,6)"))).alias("event_time"),
    )
    out = windows.mdt_versioned(records, versions)
    got = {r.bts_alt_key: r.record_cnt for r in out.collect()}
    assert len(got) == 304 and got["bts299"] == 200_000 and got["bts3"] + got["new3"] == 200_000 and got["bts3"] > got["bts0"] > 0
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


@pytest.mark.parametrize("hot", [False, True], ids=["stations", "one station of many versions"])
def test_rows_of_windows_and_stations_are_not_moved(spark, bag, plan, monkeypatch, hot):
    """Few windows and very many dated stations: stations are dealt before they meet the windows, unless one has too many rows."""
    named = [(f"c{i}", None, "SEN"[i % 3], "bts0" if hot and i % 2 else f"bts{i}", None, at(-86400)) for i in range(2000)]
    changed = [(f"c{i}", None, "SEN"[i % 3], "bts0" if hot else f"new{i % 90}", None, at(7 * i - 300)) for i in range(0, 400, 4)]
    versions, _ = dated_rows(spark, [*named, *changed])
    records = spark.range(900).select(
        F.element_at(F.array(*map(F.lit, "SEX")), (F.col("id") % 3 + 1).cast("int")).alias("bts_market_nm"), F.lit("20251201004500").alias("rqt_st_dt"),
        (F.lit(BASE).cast("timestamp") + F.make_dt_interval(secs=(F.col("id") % 800).cast("decimal(18,6)"))).alias("event_time"),
    )
    wanted = bag(windows.mdt_versioned(records, versions))
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 64_000)
    out = windows.mdt_versioned(records, versions)
    dealt = re.findall(r"hashpartitioning\((.*?)\)", plan(out))
    assert any("window" in d and "bts_alt_key" in d for d in dealt) == hot
    assert bag(out) == wanted and len(wanted) > 1000
