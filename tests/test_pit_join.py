"""Point-in-time joins."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cellmart.operators import pit_join as module
from cellmart.operators.pit_join import pit_join, with_validity

T0 = datetime(2026, 1, 1)
VERSIONS = "cell_id string, station string, valid_from timestamp"
EVENTS = "id long, cell_id string, event_time timestamp"


def test_boundaries(spark):
    snapshots = spark.createDataFrame(
        [("a", "v1", T0), ("a", "v2", T0 + timedelta(days=3)), ("a", "v3", T0 + timedelta(days=3, hours=1))], VERSIONS
    )
    times = [-timedelta(seconds=1), timedelta(0), timedelta(days=2), timedelta(days=3), timedelta(days=3, minutes=59),
             timedelta(days=3, hours=1), timedelta(days=900)]
    events = [(i, "a", T0 + t) for i, t in enumerate(times)] + [(50, "b", T0), (51, None, T0), (52, "a", None)]
    out = pit_join(spark.createDataFrame(events, EVENTS), with_validity(snapshots, "cell_id"), "cell_id")
    got = {r["id"]: r["station"] for r in out.collect()}
    assert got == {0: None, 1: "v1", 2: "v1", 3: "v2", 4: "v2", 5: "v3", 6: "v3", 50: None, 51: None, 52: None}


def test_equal_start_keeps_the_last_by_tie(spark):
    snapshots = spark.createDataFrame([("a", "v1", T0), ("a", "v9", T0), ("a", "v5", T0)], VERSIONS)
    events = spark.createDataFrame([(1, "a", T0 + timedelta(hours=1))], EVENTS)
    out = pit_join(events, with_validity(snapshots, "cell_id", ties=("station",)), "cell_id").collect()
    assert [r["station"] for r in out] == ["v9"]


@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted"])
def test_equals_range_join(spark, bag, monkeypatch, small):
    monkeypatch.setattr(module, "measured_bytes", lambda df: 0 if small else 1 << 30)
    rng = random.Random(1)

    def moment():
        return T0 + timedelta(minutes=rng.randint(0, 20000))

    keys = ["hot"] * 5 + ["a", "b", "c", None]
    seen = {(rng.choice(keys), moment()) for _ in range(200)}
    snapshots = spark.createDataFrame([(k, f"s{i}", t) for i, (k, t) in enumerate(sorted(seen, key=str))], VERSIONS)
    events = spark.createDataFrame([(i, rng.choice([*keys, "zz"]), moment()) for i in range(1000)], EVENTS)
    versions = with_validity(snapshots, "cell_id")
    v = versions.withColumnRenamed("cell_id", "k")
    direct = events.join(
        v,
        (F.col("cell_id") == F.col("k"))
        & (F.col("event_time") >= F.col("valid_from"))
        & (F.col("valid_to").isNull() | (F.col("event_time") < F.col("valid_to"))),
        "left",
    )
    got = pit_join(events, versions, "cell_id")
    assert bag(got) == bag(direct, "id", "cell_id", "event_time", "station")
    assert got.count() == 1000


def test_long_versions_take_few_rows(spark, bag):
    starts = [datetime(1950, 1, 1), datetime(2000, 1, 1), datetime(2026, 1, 1), datetime(2026, 1, 2, 5), datetime(2026, 3, 1)]
    snapshots = spark.createDataFrame([("a", f"v{i}", t) for i, t in enumerate(starts)], VERSIONS)
    versions = with_validity(snapshots, "cell_id")
    listed = module._listed(versions, "valid_from")
    assert listed.selectExpr("max(_last - _first)").first()[0] <= module.CELLS
    assert {r["_width"] for r in listed.collect()} == {1, 32, 1024}
    times = [datetime(1949, 12, 31)] + [t + d for t in starts for d in (timedelta(0), timedelta(hours=30), -timedelta(seconds=1))]
    events = spark.createDataFrame([(i, "a", t) for i, t in enumerate(times)], EVENTS)
    got = {r["event_time"]: r["station"] for r in pit_join(events, versions, "cell_id").collect()}
    assert got == {t: next((f"v{i}" for i in range(4, -1, -1) if starts[i] <= t), None) for t in times}


def test_events_are_moved_once_for_keys_of_few_versions(spark, bag, monkeypatch):
    """Versions of a key are one row while they are few, so events meet them in one join; keys of many go by cells."""
    ends = [timedelta(0), timedelta(hours=5), timedelta(days=70), timedelta(days=71), timedelta(days=3000)]
    rows = [(k, f"{k}{i}", T0 + t) for k in "abc" for i, t in enumerate(ends)]
    versions = with_validity(spark.createDataFrame(rows, VERSIONS), "cell_id")
    events = spark.createDataFrame([(i, "abcd"[i % 4], T0 + timedelta(hours=i * 9)) for i in range(400)], EVENTS)
    joins, join = [], module.dim_join

    def counted(fact, dim, on, *rest, **options):
        joins.append(on)
        return join(fact, dim, on, *rest, **options)

    monkeypatch.setattr(module, "dim_join", counted)
    once = bag(pit_join(events, versions, "cell_id"))
    assert joins == [["cell_id"]]
    monkeypatch.setattr(module, "PACKED", 0)
    assert bag(pit_join(events, versions, "cell_id")) == once
    assert len(joins) > 3
    monkeypatch.setattr(module, "PACKED", 4)
    more = spark.createDataFrame([*rows, ("e", "e0", T0), ("d", None, T0 + timedelta(days=9000))], VERSIONS)
    assert bag(pit_join(events, with_validity(more, "cell_id"), "cell_id")) == once
    monkeypatch.setattr(module, "measured_bytes", lambda df: 1 << 30)
    assert bag(pit_join(events, with_validity(more, "cell_id"), "cell_id")) == once
