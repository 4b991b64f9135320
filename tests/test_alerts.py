"""The running alert and the digests of parity: against plain computations, late rows included."""

import datetime as dt
import random

import numpy as np
from pyspark.sql import functions as F

from cellmart.plans import audit
from cellmart.session import scratch_path
from cellmart.streaming import alerts

BASE = dt.datetime(2025, 12, 1, 8, 0)
FIELDS = "engine string, elapsed_sec double, started_at timestamp"


def test_quantiles_of_sketches_stay_within_their_error(spark):
    rng = random.Random(2)
    sets = [[rng.lognormvariate(0, 3) for _ in range(n)] for n in (1, 2, 7, 400)] + [[5.0] * 30, [0.0, 0.0, 1e6]]
    rows = [(i, v) for i, values in enumerate(sets) for v in values]
    counts = spark.createDataFrame(rows, "i int, v double").groupBy("i", alerts.bucket_of(F.col("v")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    sketches = counts.groupBy("i").agg(F.collect_list(F.struct("bucket", "n")).alias("b"), F.sum("n").alias("t"))
    for p in (0.0, 0.5, 0.95, 1.0):
        got = {r.i: r.q for r in sketches.select("i", alerts.quantile(F.col("b"), F.col("t"), p).alias("q")).collect()}
        for i, values in enumerate(sets):
            assert abs(got[i] - np.quantile(values, p)) <= alerts.ERROR * np.quantile(values, p) + 1e-8


def timings(minutes, slow):
    """Twenty timings of two engines a minute; over the limit in the minutes ``slow``."""
    rows = []
    for m in minutes:
        for k in range(20):
            at = BASE + dt.timedelta(minutes=m, seconds=3 * k)
            rows += [("a", 9.0 if m in slow else 1.0, at), ("b", 1.0, at), ("a", -1.0, at)]
    return rows


def test_stream_emits_closed_stretches_once_and_drops_late_rows(spark):
    slow = {*range(3, 9), *range(12, 15), *range(20, 30)}
    source, sink = scratch_path(spark, "timings"), scratch_path(spark, "alerts")
    spark.createDataFrame([], FIELDS).write.parquet(source)
    rows = spark.readStream.schema(FIELDS).option("maxFilesPerTrigger", 1).parquet(source).withWatermark("started_at", "10 seconds")
    found = alerts.latency_alerts(rows)
    late = [("b", 99.0, BASE + dt.timedelta(minutes=m, seconds=1)) for m in range(3, 9) for _ in range(50)]
    for part in (timings(range(0, 11), slow), timings(range(11, 26), slow), late, timings(range(26, 40), slow)):
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(source)
        query = found.writeStream.outputMode("append").option("checkpointLocation", f"{sink}-state").format("parquet")
        query.trigger(availableNow=True).start(f"{sink}/rows").awaitTermination()
    got = {(r.engine, r.first_slot.minute, r.last_slot.minute, r.slots) for r in spark.read.parquet(f"{sink}/rows").collect()}
    assert got == {("a", 3, 8, 6), ("a", 20, 29, 10)}
    exact = audit.latency_alerts(spark.createDataFrame(timings(range(40), slow), FIELDS)).collect()
    assert {(r.engine, r.first_slot.minute, r.last_slot.minute, r.slots) for r in exact} == got


def test_digests_name_the_keys_that_differ(spark, bag):
    rng = random.Random(4)
    rows = [(BASE + dt.timedelta(minutes=5 * i), rng.choice(["x", "y", None]) if i % 7 else f"s{i}", i) for i in range(900)]
    rows = list({r[:2]: r for r in rows}.values())
    other = [r for i, r in enumerate(rows) if i % 211] + [(BASE + dt.timedelta(days=9), "new", 1), (None, "none", 4)]
    other = [(s, k, v + 1 if v in (33, 700) else v) for s, k, v in other]
    batch, stream = (spark.createDataFrame(x, "window_start timestamp, k string, record_cnt long") for x in (rows, other))
    on = ["window_start", "k"]
    whole = audit.parity(batch, stream, on, ["record_cnt"])
    whole = whole.where("side <> 'both' OR diff_record_cnt <> 0")
    found = audit.parity_digests(batch, stream, on, ["record_cnt"])
    assert bag(found) == bag(whole) and len(bag(found)) >= 7
    assert audit.parity_digests(batch, batch.repartition(7), on, ["record_cnt"]).collect() == []
