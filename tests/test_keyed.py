"""Base and delta files: what is read is what a plain merge gives, and only what changed is written."""

import os
import random

from pyspark.sql import types as T

from cellmart.session import scratch_path
from cellmart.sources import keyed
from cellmart.sources.keyed import KeyedStore

FIELDS = T.StructType().add("k", "string").add("day", "string").add("v", "long")


def size(path):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet"))


def files(df):
    return [f.split("/delta/")[-1].split("/base/")[-1] for f in df.inputFiles()]


def test_merges_folds_and_replays(spark):
    rng = random.Random(1)
    store = KeyedStore(spark, scratch_path(spark, "keyed"), FIELDS, "k", ["day"], buckets=8)
    rows = {f"k{i}": (f"2025{rng.randrange(10, 13)}", i) for i in range(500)}
    store.create(spark.createDataFrame([(k, *v) for k, v in rows.items()], FIELDS))
    expected = dict(rows)

    def changed(seq, keys):
        return [(f"k{rng.choice(keys)}", f"2025{rng.randrange(9, 13):02}", 1000 * seq + i) for i in range(60)]

    def merged(changes):
        newest = {}
        for k, day, v in changes:
            newest[k] = max(newest.get(k, ("", -1)), (day, v))
        for k, row in newest.items():
            if k not in expected or row[0] >= expected[k][0]:
                expected[k] = row

    def same():
        got = {r.k: (r.day, r.v) for r in store.read().collect()}
        assert got == expected
        for k in ("k1", "k499", "k505", "none"):
            assert [tuple(r)[1:] for r in store.lookup(k).collect()] == ([expected[k]] if k in expected else [])

    same()
    written = []
    for seq in range(4):
        changes = changed(seq, range(480, 520) if seq % 2 else range(520))
        df = spark.createDataFrame([*changes, (None, "2025", 1)], FIELDS)
        store.apply(df, seq)
        store.apply(df, seq)
        merged(changes)
        same()
        written.append(size(f"{store.path}/delta/seq={seq}"))
        if seq == 1:
            folded = store.fold(14)
            assert 0 < len(folded) < 8
            same()
            # a change set that runs again after it was folded adds nothing
            store.apply(df, seq)
            same()
    assert store.fold(1) and store.fold(1) == []
    same()


def test_a_change_set_writes_its_own_rows_and_a_lookup_reads_one_bucket(spark, plan):
    store = KeyedStore(spark, scratch_path(spark, "keyed"), FIELDS, "k", ["day"], buckets=16)
    store.create(spark.range(200_000).selectExpr("concat('k', id) AS k", "'20251201' AS day", "id AS v"))
    before = size(f"{store.path}/base")
    store.apply(spark.createDataFrame([("k7", "20251202", 1), ("new", "20251202", 2)], FIELDS), 0)
    assert size(f"{store.path}/base") == before and size(f"{store.path}/delta") < before / 50
    found = store.lookup("k7")
    assert [tuple(r) for r in found.collect()] == [("k7", "20251202", 1)]
    buckets = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles()}
    text = plan(found)
    assert len(buckets) >= 1 and "PartitionFilters" in text and text.count("(bucket#") >= 2
    folded = store.fold(1)
    assert 1 <= len(folded) <= 2 and size(f"{store.path}/base") < 1.3 * before
    assert store.read().count() == 200_001


def test_empty_tables(spark):
    store = KeyedStore(spark, scratch_path(spark, "keyed"), FIELDS, "k", ["day"], buckets=4)
    store.create(spark.createDataFrame([], FIELDS))
    assert store.read().collect() == [] and store.lookup("a").collect() == [] and store.fold(1) == []
    store.apply(spark.createDataFrame([("a", None, 1), ("a", "1", 2)], FIELDS), 5)
    assert [tuple(r) for r in store.read().collect()] == [("a", "1", 2)]


def test_bloom_filters_skip_row_groups_of_absent_keys(spark):
    """Calls are scattered over all buckets and row groups: only a filter, not a smallest and largest value, can rule a group out."""
    from pyspark.sql import functions as F

    from cellmart.plans import lookup
    from cellmart.sources import writers

    rows = spark.range(40_000).select(
        F.format_string("KEY_%05d", "id").alias("lookup_key"), F.format_string("CALL_%05d", (F.col("id") * 7919) % 20_000 * 2).alias("call_id"),
        F.lit(-70).alias("rsrp"), F.lit(-9).alias("rsrq"), F.lit("N").alias("drop_flag"), F.lit("20251201").alias("base_date"), F.lit("{}").alias("detail_json"),
    )
    writers.write_bucketed(rows, "call_quality_kudu", "filtered", path=scratch_path(spark, "filtered"), buckets=4, files=1)

    def read(**wanted):
        """Rows found, and rows that the scan gave out."""
        df = lookup.by_other_key(spark.table("filtered"), **wanted)
        found = df.collect()
        text = df._jdf.queryExecution().executedPlan()
        scans = [text.collectLeaves().apply(i) for i in range(text.collectLeaves().size())]
        return len(found), sum(s.metrics().apply("numOutputRows").value() for s in scans)

    assert read(call_id="CALL_00011") == (0, 0)
    found, scanned = read(call_id="CALL_00010")
    assert found == 2 and 2 <= scanned < 40_000


def test_a_large_change_set_moves_each_side_once(spark, tmp_path, bag, plan, monkeypatch):
    """Beyond what is broadcast, base and changes meet in one full join, with the same rows."""
    fields = "k string, v long, at long"
    base = spark.range(60).selectExpr("concat('k', id) AS k", "id AS v", "5L AS at")
    changes = spark.range(30, 90).selectExpr("concat('k', id) AS k", "id * 10 AS v", "id % 10 AS at")
    store = keyed.KeyedStore(spark, str(tmp_path), T.StructType.fromDDL(fields), "k", ["at"], buckets=4)
    store.create(base)
    store.apply(changes, 0)
    small = bag(store.read())
    monkeypatch.setattr(keyed, "is_small", lambda size: False)
    large = store.read()
    assert bag(large) == small and len(small) == 90
    assert plan(large).count("FullOuter") >= 1 and "Generate" not in plan(large)
