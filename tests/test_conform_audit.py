"""Conforming rules, audits, numbering and quantiles."""

import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

import seed
from cellmart.operators.numbering import exact_quantiles, row_index
from cellmart.plans import audit, conform
from cellmart.streaming import windows

T0 = datetime(2026, 8, 3, 12, 0)


@pytest.mark.parametrize("order", [None, ["v"]])
def test_row_index_is_dense(spark, order):
    df = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") * 31 % 1009).alias("v")).repartition(7)
    indexed, total = row_index(df, "n", order)
    rows = indexed.orderBy("n").collect()
    assert total == 5000 and [r["n"] for r in rows] == list(range(5000))
    if order:
        values = [r["v"] for r in rows]
        assert values == sorted(values)


def test_row_index_of_nothing(spark):
    indexed, total = row_index(spark.range(0).withColumnRenamed("id", "v"), "n", ["v"])
    assert total == 0 and indexed.count() == 0


def test_repaired_keys(spark):
    rows = [(f"r{i}", "CELL_A" if i % 2 else f"bad{i}", "old") for i in range(100)] + [("n", None, "old"), (None, "bad", "old")]
    facts = spark.createDataFrame(rows, "sgi_id string, cell_id string, alt_cell_id string")
    out = conform.repair_keys(facts, seed.bts(spark))
    got = out.collect()
    valid = {c for c, *_ in seed.BTS}
    assert len(got) == 102 and {r["cell_id"] for r in got} <= valid
    assert all(r["alt_cell_id"] == f"{r['cell_id']}_ALT" for r in got)
    assert len({r["cell_id"] for r in got if r["sgi_id"] and int((r["sgi_id"][1:] or 1)) % 2 == 0}) > 5
    assert sorted(map(repr, got)) == sorted(map(repr, conform.repair_keys(facts, seed.bts(spark)).collect()))
    with pytest.raises(ValueError):
        conform.repair_keys(facts, seed.bts(spark).where("false"))


def test_repaired_domain(spark):
    df = spark.createDataFrame([("1", "Y"), ("2", "maybe"), ("3", None), ("4", "N")], "id string, use_flag string")
    got = {r["id"]: r["use_flag"] for r in conform.repair_domain(df, "use_flag", ("Y", "N"), "id").collect()}
    assert got["1"] == "Y" and got["4"] == "N" and {got["2"], got["3"]} <= {"Y", "N"}


def test_clip_and_fill(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, -4), (4, 99_000_000)], "id int, val long")
    out = conform.clip_fill(df, "val", 0, 0, 10_000_000)
    assert [r["val"] for r in out.orderBy("id").collect()] == [5, 0, 0, 10_000_000]
    assert out.schema["val"].dataType == df.schema["val"].dataType
    xs = spark.createDataFrame([(1, float("nan")), (2, None), (3, 1.0), (4, 2e9)], "id int, x double")
    out = conform.clip_fill(xs, "x", conform.X_DEFAULT, conform.X_LOW, conform.X_HIGH)
    assert [r["x"] for r in out.orderBy("id").collect()] == [961000.0, 961000.0, 900000.0, 1100000.0]


def test_conformed_records(spark):
    raw = seed.cdr(spark).withColumns({"cell_id": F.lit("?"), "use_flag": F.lit(None).cast("string"), "val": -F.col("val")})
    out = conform.conform_cdr(raw, seed.bts(spark), ["event_time"])
    rows = out.orderBy("sgi_id").collect()
    assert out.columns == raw.columns
    assert [r["sgi_id"] for r in rows] == [f"SGI{i:012d}" for i in range(12)]
    assert rows[0]["event_time"] == seed.at("12:40:30") and rows[0]["rqt_st_dt"] == "20260803124030"
    assert {r["val"] for r in rows} == {0} and {r["etl_date"] for r in rows} == {"20260803"}
    assert {r["use_flag"] for r in rows} <= {"Y", "N"}
    mdt = conform.conform_mdt(seed.mdt(spark).withColumn("bts_market_nm", F.lit("x")), order_by=["mdt_id"])
    rows = mdt.orderBy("mdt_id").collect()
    assert [r["mdt_id"] for r in rows] == [f"MDT{i:012d}" for i in range(10)]
    assert {r["bts_market_nm"] for r in rows} <= {"SAMSUNG", "ERICSSON", "NOKIA"}


def test_expanded_stations(spark):
    few = conform.expand_stations(spark, seed.bts(spark), 4)
    assert {r["cell_id"] for r in few.collect()} == {"CELL_A", "CELL_B", "CELL_C", "CELL_D"}
    few = conform.expand_stations(spark, seed.bts(spark).repartition(7, "region_cd"), 4)
    assert {r["cell_id"] for r in few.collect()} == {"CELL_A", "CELL_B", "CELL_C", "CELL_D"}
    many = conform.expand_stations(spark, seed.bts(spark), 25)
    row = many.where("cell_id = 'CELL_000013'").first()
    assert tuple(row) == ("CELL_000013", "CELL_000013_ALT", "BTS_INCHEON_0013", "ERICSSON", "INCHEON")
    assert many.count() == 25


def test_load_summary(spark):
    out = conform.load_summary({"bts": seed.bts(spark), "cdr": seed.cdr(spark), "mdt": seed.mdt(spark)})
    assert {tuple(r) for r in out.collect()} == {("bts", 10, None), ("cdr", 12, 10), ("mdt", 10, 7)}
    assert {tuple(r) for r in audit.eligible_counts({"cdr": seed.cdr(spark)}).collect()} == {("cdr", 10)}


def test_row_count_audit(spark):
    expected = spark.createDataFrame([("a", 12), ("b", 11)], "tbl string, expected long")
    tables = {"a": seed.cdr(spark), "b": seed.bts(spark), "c": seed.mdt(spark)}
    got = {tuple(r) for r in audit.row_count_audit(tables, expected).collect()}
    assert got == {("a", 12, 12, "ok"), ("b", 10, 11, "mismatch"), ("c", 10, None, "pending")}


def test_parity(spark):
    schema = "w int, k string, record_cnt long"
    batch = spark.createDataFrame([(1, "a", 5), (1, None, 2), (2, "a", 7), (3, "b", 1)], schema)
    stream = spark.createDataFrame([(1, "a", 5), (1, None, 3), (2, "a", 7), (4, "c", 9)], schema)
    compared = audit.parity(batch, stream, ["w", "k"], ["record_cnt"])
    sides = {(r["w"], r["k"]): (r["side"], r["diff_record_cnt"]) for r in compared.collect()}
    assert sides == {
        (1, "a"): ("both", 0), (1, None): ("both", 1), (2, "a"): ("both", 0), (3, "b"): ("batch", -1), (4, "c"): ("stream", 9),
    }
    assert tuple(audit.parity_summary("j", compared).first()) == ("j", 15, 24, 9, 3)
    sink = windows.ltas(seed.cdr(spark), seed.bts(spark))
    assert tuple(audit.parity_counts("j", batch, sink, datetime(2026, 8, 3, 12, 45)).first()) == ("j", 4, 10, 6)
    assert tuple(audit.parity_counts("j", batch, sink, datetime(2026, 8, 3, 12, 40)).first()) == ("j", 4, None, None)


def test_latest_and_checked_windows(spark):
    cdr, bts = seed.cdr(spark), seed.bts(spark)
    sinks = {"l": windows.ltas(cdr, bts, None), "m": windows.mdt(seed.mdt(spark), bts, None)}
    out = audit.latest_windows(sinks, 2).collect()
    assert [(r["tbl"], r["window_start"].minute, r["bts_alt_key"]) for r in out if r["tbl"] == "l"] == [
        ("l", 50, "BTS_NORTH_01"), ("l", 45, "BTS_COAST_01"),
    ]
    assert sum(r["tbl"] == "m" and r["total_val"] is None for r in out) == 2
    assert audit.window_violations(sinks["l"]).count() == 0
    assert audit.filter_violations(sinks["l"], cdr).count() == 2  # 12:40 and 12:50 hold no minute 45
    broken = sinks["l"].withColumn("window_end", F.col("window_end") + F.expr("INTERVAL 1 MINUTE"))
    assert audit.window_violations(broken).count() == sinks["l"].count()


def test_history_and_range(spark):
    rows = [(i, "s", T0 - timedelta(hours=i), 1500) for i in range(60)]
    log = spark.createDataFrame(rows, "query_id long, stmt string, start_time timestamp, duration_ms long")
    out = audit.recent_history(log, T0, n=50).collect()
    assert [r["query_id"] for r in out] == list(range(24)) and out[0]["duration_sec"] == 1.5
    assert len(audit.recent_history(log, T0, hours=99, n=50).collect()) == 50
    assert tuple(audit.time_range({"log": log}, "start_time").first())[1:] == (T0 - timedelta(hours=59), T0)


@pytest.mark.parametrize("parts", [3, 256])
def test_quantiles_are_exact(spark, parts):
    rng = random.Random(3)
    rows = [("a", rng.expovariate(0.1)) for _ in range(2000)] + [("a", 2.5)] * 1000 + [("b", 1.0), ("b", 2.0), ("c", 4.0), (None, 8.0), (None, 9.0)]
    # far values, which widen no part
    rows += [("a", None), ("a", 1e12), ("b", float("inf"))]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    probs = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    found = exact_quantiles(df, ["g"], "v", probs, parts).collect()
    assert {r["g"] for r in found} == {"a", "b", "c", None}
    for r in found:
        values = [v for g, v in rows if g == r["g"] and v is not None]
        for name, p in probs.items():
            if r["g"] != "b":
                assert r[name] == pytest.approx(np.quantile(values, p))
    b = next(r for r in found if r["g"] == "b")
    assert (b["p0"], b["p50"], b["p100"]) == (1.0, 2.0, float("inf"))


def test_latency(spark):
    rows = [("x", float(i), T0) for i in range(1, 101)] + [("x", -1.0, T0), ("y", -1.0, T0)]
    out = audit.latency_summary(spark.createDataFrame(rows, "engine string, elapsed_sec double, started_at timestamp"))
    row = out.collect()
    assert len(row) == 1 and row[0]["n"] == 100 and row[0]["avg_sec"] == 50.5 and row[0]["max_sec"] == 100.0
    assert row[0]["p95_sec"] == pytest.approx(95.05) and row[0]["p99_sec"] == pytest.approx(99.01)


def test_latency_alerts(spark):
    slow = {"x": [0, 1, 2, 3, 4, 6, 7, 8, 9], "y": [1, 3, 5, 7, 9], "z": [20, 21, 22, 23, 24, 25]}
    rows = [
        (engine, 4.0 if minute in bad else 1.0, T0 + timedelta(minutes=minute, seconds=s))
        for engine, bad in slow.items()
        for minute in range(30)
        for s in (1, 30)
    ]
    out = audit.latency_alerts(spark.createDataFrame(rows, "engine string, elapsed_sec double, started_at timestamp"))
    got = {(r["engine"], r["first_slot"].minute, r["last_slot"].minute, r["slots"]) for r in out.collect()}
    assert got == {("x", 0, 4, 5), ("z", 20, 25, 6)}
