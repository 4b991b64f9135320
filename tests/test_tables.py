"""Reading and writing tables, lookups, upsert and upkeep."""

from datetime import date, datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import seed
from cellmart.operators import sizing
from cellmart.operators.upsert import upsert
from cellmart.plans import lookup, upkeep
from cellmart.schemas import RESULTS, STAGING, TABLES, schema
from cellmart.sources import readers, writers

QUALITY = [
    (f"LOOKUP_KEY_{i:05d}", f"CALL_{i % 7}", -60 - i, -i, "Y" if i % 2 else "N", f"2025120{i % 3 + 1}", "{}")
    for i in range(200)
]


@pytest.fixture
def quality(spark):
    return readers.literal_rows(spark, "call_quality_kudu", QUALITY)


def test_catalogue():
    assert len(TABLES) == 24
    assert TABLES["cdr_sgi_raw"].partition_column == "event_date"
    assert TABLES["ltas_5min_flink"].partition_column == "window_date"
    for table in TABLES.values():
        for column in (table.partition_by, table.day_of, table.sort_by, table.bucket_by, *table.key):
            assert column is None or column in table.schema.names


@pytest.mark.parametrize("unit", ["ns", "us"])
def test_raw_timestamps(spark, tmp_path, unit):
    """Nanosecond and microsecond drops give the same wall clock."""
    nanos = 1785761100123456789
    value = nanos if unit == "ns" else nanos // 1000
    columns = {
        "sgi_id": ["1"], "cell_id": ["c"], "alt_cell_id": ["a"], "rqt_st_dt": ["20260803124500"],
        "etl_date": ["20260803"], "val": pa.array([5], pa.int64()), "use_flag": ["Y"], "signal_type": ["SGI"],
        "event_time": pa.array([value], pa.int64()).cast(pa.timestamp(unit)),
    }
    path = str(tmp_path / "cdr_sgi_raw.parquet")
    pq.write_table(pa.table(columns), path)
    out = readers.read_raw(spark, path, "cdr_sgi_raw")
    assert out.schema == schema("cdr_sgi_raw")
    assert out.first()["event_time"] == datetime(2026, 8, 3, 12, 45, 0, 123456)


def test_load_drop(spark, tmp_path):
    staging, warehouse = str(tmp_path / "staging"), str(tmp_path / "warehouse")
    seed.bts(spark).write.parquet(f"{staging}/bts_master.parquet")
    seed.cdr(spark).write.parquet(f"{staging}/cdr_sgi_raw.parquet")
    seed.mdt(spark).write.parquet(f"{staging}/cdr_mdt_smsng_raw.parquet")
    for _ in range(2):
        writers.load_drop(spark, staging, warehouse)
    counts = {n: readers.read_table(spark, f"{warehouse}/{n}", n).count() for n in ("bts_master", "cdr_sgi_raw", "cdr_mdt_smsng_raw")}
    assert counts == {"bts_master": 10, "cdr_sgi_raw": 24, "cdr_mdt_smsng_raw": 20}  # facts are appended
    stored = readers.read_table(spark, f"{warehouse}/cdr_sgi_raw", "cdr_sgi_raw")
    assert {r[0] for r in stored.select("event_date").distinct().collect()} == {date(2026, 8, 3)}


def test_seed_csv_keeps_empty_text(spark, tmp_path):
    path = tmp_path / "m.csv"
    path.write_text('mdt_id,trigr_ev,event_time\n1,"",2026-08-03 12:45:00\n2,\\N,2026-08-03 12:45:01\n3,PERIODIC,\\N\n')
    rows = readers.read_seed(spark, str(path), "cdr_mdt_smsng", ["mdt_id", "trigr_ev", "event_time"]).collect()
    assert [r["trigr_ev"] for r in rows] == ["", None, "PERIODIC"]
    assert rows[0]["event_time"] == datetime(2026, 8, 3, 12, 45) and rows[2]["event_time"] is None


def test_partition_values_stay_text_and_days_survive(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(f"2025120{d}", "c", 1, datetime(2026, 1, 1)) for d in (1, 2)]
    frame = readers.literal_rows(spark, "tfm_s1ap_sgi_use_dd_v1", rows)
    writers.overwrite_partitions(frame, path, "tfm_s1ap_sgi_use_dd_v1")
    writers.overwrite_partitions(frame.where("etl_date = '20251202'").withColumn("use_cnt", F.lit(9).cast("long")), path, "tfm_s1ap_sgi_use_dd_v1")
    out = readers.read_table(spark, path, "tfm_s1ap_sgi_use_dd_v1")
    assert {(r["etl_date"], r["use_cnt"]) for r in out.collect()} == {("20251201", 1), ("20251202", 9)}
    writers.append(frame, path, "tfm_s1ap_sgi_use_dd_v1")
    assert readers.read_table(spark, path, "tfm_s1ap_sgi_use_dd_v1").count() == 4
    writers.reload(frame.limit(1), path, "tfm_s1ap_sgi_use_dd_v1")
    assert readers.read_table(spark, path, "tfm_s1ap_sgi_use_dd_v1").count() == 1


def test_a_day_of_a_stored_table_is_read_by_partition(spark, tmp_path, plan, monkeypatch):
    raw = str(tmp_path / "raw")
    writers.overwrite_partitions(seed.cdr(spark), raw, "cdr_sgi_raw")
    plans = []
    monkeypatch.setattr(writers, "overwrite_partitions", lambda df, path, table: plans.append(plan(df)))
    writers.ingest_slice(spark, readers.read_table(spark, raw, "cdr_sgi_raw"), "unused", "cdr_sgi_raw", "2026-08-03")
    filters = next(line for line in plans[0].splitlines() if line.startswith("PartitionFilters"))
    assert "event_date" in filters and "2026-08-03" in filters


def test_ingest_slice(spark, tmp_path, quality):
    path = str(tmp_path / "q")
    writers.ingest_slice(spark, quality, path, "call_quality_iceberg", "20251201")
    writers.ingest_slice(spark, quality, path, "call_quality_iceberg", "20251202")
    out = readers.read_table(spark, path, "call_quality_iceberg")
    assert {r[0] for r in out.select("base_date").distinct().collect()} == {"20251201", "20251202"}
    raw = str(tmp_path / "raw")
    writers.ingest_slice(spark, seed.cdr(spark), raw, "cdr_sgi_raw", "2026-08-03")
    assert readers.read_table(spark, raw, "cdr_sgi_raw").count() == 12
    bts = str(tmp_path / "bts")
    full = readers.literal_rows(spark, "bts_master", [("c", "a", "k", "NOKIA", 1.0, 2.0, "R", None, 3)])
    writers.ingest_slice(spark, full, bts, "bts_master")
    assert readers.read_table(spark, bts, "bts_master").count() == 1


def test_bucketed_lookup_reads_one_bucket(spark, quality, plan, bag):
    writers.create_databases(spark)
    writers.write_bucketed(quality, "call_quality_kudu", "cellmart.quality_hash")
    table = spark.table("cellmart.quality_hash")
    hit = lookup.by_key(table, "LOOKUP_KEY_00007")
    assert "SelectedBucketsCount: 1 out of 32" in plan(hit)
    assert "PushedFilters: [IsNotNull(lookup_key), EqualTo(lookup_key,LOOKUP_KEY_00007)]" in plan(hit)
    assert bag(hit) == [repr(QUALITY[7])]
    assert lookup.by_key(table, "nope").count() == 0
    assert hit.columns == schema("call_quality_kudu").names


def test_partitioned_lookup_prunes(spark, quality, plan, tmp_path):
    path = str(tmp_path / "q")
    writers.write_clustered(quality, path, "call_quality_iceberg", 2)
    table = readers.read_table(spark, path, "call_quality_iceberg")
    hit = lookup.by_key_and_date(table, "LOOKUP_KEY_00007", "20251202")
    assert hit.first()["call_id"] == "CALL_0"
    assert "PartitionFilters: [isnotnull(base_date" in plan(hit) and "EqualTo(lookup_key" in plan(hit)
    assert lookup.by_key_and_date(table, "LOOKUP_KEY_00007", "20251203").count() == 0


def test_lookup_by_call(spark, quality, plan):
    writers.create_databases(spark)
    writers.write_bucketed(lookup.quality_by_call(quality), "call_quality_kudu_by_call", "cellmart.quality_by_call")
    table = spark.table("cellmart.quality_by_call")
    assert table.count() == table.select("call_id", "base_date").distinct().count() == 21
    hit = lookup.by_call(table, "CALL_3", "20251202", "20251203")
    assert "SelectedBucketsCount: 1 out of 16" in plan(hit)
    assert {r["base_date"] for r in hit.collect()} == {"20251202", "20251203"}


def test_key_list(spark, quality):
    keys = spark.createDataFrame([("LOOKUP_KEY_00001",), ("LOOKUP_KEY_00001",), ("LOOKUP_KEY_99999",), (None,)], "lookup_key string")
    out = lookup.by_keys(quality, keys).collect()
    assert sorted((str(r["lookup_key"]), r["found"], r["call_id"]) for r in out if r["lookup_key"] != "LOOKUP_KEY_00001") == [
        ("LOOKUP_KEY_99999", False, None), ("None", False, None),
    ]
    assert sum(r["found"] for r in out) == 2


def test_long_key_list_moves_the_table_once(spark, quality, bag, plan, monkeypatch):
    """Beyond a broadcast there is one join, and the list is grouped once; a listed key that is hot or missing changes nothing."""
    keys = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "LOOKUP_KEY_00001").otherwise(F.format_string("LOOKUP_KEY_%05d", "id")).alias("lookup_key"))
    keys = keys.unionByName(spark.createDataFrame([(None,)], "lookup_key string"))
    few = lookup.by_keys(quality, keys)
    wanted = bag(few)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 4_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = lookup.by_keys(quality, keys)
        text = plan(many).split("\n\n")[0]
        assert text.count("Join") == 1 and text.count("Exchange") == 2 and "Aggregate" not in text
        assert bag(many) == wanted and len(wanted) == 3001
        assert "BroadcastHashJoin" in plan(few)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_upsert(spark):
    base = spark.createDataFrame([("a", 1, "old"), ("b", 5, "old"), ("c", 1, "old")], "k string, seq int, v string")
    changes = spark.createDataFrame(
        [("a", 2, "mid"), ("a", 3, "new"), ("b", 4, "stale"), ("c", 1, "same"), ("d", 1, "added")], "k string, seq int, v string"
    )
    got = {tuple(r) for r in upsert(base, changes, ["k"], ["seq"]).collect()}
    assert got == {("a", 3, "new"), ("b", 5, "old"), ("c", 1, "same"), ("d", 1, "added")}
    keyless = spark.createDataFrame([(None, 1, "kept")], base.schema)
    assert upsert(base.unionByName(keyless), changes, ["k"], ["seq"]).where("k IS NULL").first()["v"] == "kept"
    assert upsert(base.limit(0), changes, ["k"], ["seq"]).count() == 4
    assert upsert(base, changes.limit(0), ["k"], ["seq"]).count() == 3


def test_upsert_leaves_a_bucketed_base_in_place(spark, quality, plan):
    writers.create_databases(spark)
    writers.write_bucketed(quality, "call_quality_kudu", "cellmart.quality_base")
    merged = upsert(spark.table("cellmart.quality_base"), quality.limit(5), ["lookup_key"], ["base_date"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(merged)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SelectedBucketsCount: 32 out of 32" in text
    shuffled = [line for line in text.splitlines() if "Arguments: hashpartitioning(_old_lookup_key" in line]
    assert shuffled == [] and "hashpartitioning(" in text
    assert merged.count() == 200


def test_published_versions(spark, quality, plan):
    newer = quality.limit(3).withColumn("base_date", F.lit("20260101"))
    first = writers.publish_upsert(spark, quality, newer, ["lookup_key"], ["base_date"], "quality_now")
    assert spark.table("quality_now").where("base_date = '20260101'").count() == 3
    again = newer.withColumn("base_date", F.lit("20260102"))
    second = writers.publish_upsert(spark, spark.table("quality_now"), again, ["lookup_key"], ["base_date"], "quality_now")
    assert first != second and spark.table("quality_now").count() == 200
    assert spark.table(first).where("base_date = '20260102'").count() == 0
    # another session reads the new version, and one bucket of it for a key
    other = spark.newSession().table("quality_now")
    assert other.where("base_date = '20260102'").count() == 3
    found = plan(other.where("lookup_key = 'LOOKUP_KEY_00001'"))
    assert "SelectedBucketsCount: 1 out of 32" in found


def test_compacted_keyed_table_keeps_its_buckets(spark, quality, plan, bag):
    writers.publish_keyed(quality.repartition(8), "quality_packed")
    before = bag(spark.table("quality_packed"))
    version = writers.publish_keyed(spark.table("quality_packed"), "quality_packed", files=1)
    assert bag(spark.table("quality_packed")) == before
    assert spark.table(version).select(F.input_file_name()).distinct().count() <= 32
    assert "SelectedBucketsCount: 1 out of 32" in plan(spark.table("quality_packed").where("lookup_key = 'LOOKUP_KEY_00001'"))


def test_clustered_write_orders_files(spark, tmp_path):
    rows = [(f"s{i}", f"c{i % 50:02d}" if i % 3 else "hot", "20251201") for i in range(900)]
    frame = readers.literal_rows(spark, "cdr_sgi", rows, ["sgi_id", "cell_id", "etl_date"]).repartition(5)
    path = str(tmp_path / "cdr")
    writers.write_clustered(frame, path, "cdr_sgi", 6)
    ranges = (
        spark.read.parquet(path).groupBy(F.input_file_name().alias("f"))
        .agg(F.min("cell_id").alias("lo"), F.max("cell_id").alias("hi"), F.count(F.lit(1)).alias("n")).orderBy("lo", "hi").collect()
    )
    assert len(ranges) >= 5 and max(r["n"] for r in ranges) < 300  # the hot cell is split
    assert all(a["hi"] <= b["lo"] for a, b in zip(ranges, ranges[1:], strict=False))


def test_compaction(spark, tmp_path, quality, bag):
    path, out = str(tmp_path / "many"), str(tmp_path / "few")
    writers.overwrite_partitions(quality.repartition(20), path, "call_quality_iceberg")
    assert upkeep.compact(spark, path, "call_quality_iceberg", out) == 1
    before, after = (readers.read_table(spark, p, "call_quality_iceberg") for p in (path, out))
    assert bag(before) == bag(after)
    assert upkeep.file_sizes(spark, path).count() > upkeep.file_sizes(spark, out).count() == 3
    assert upkeep.compact(spark, path, "call_quality_iceberg", str(tmp_path / "some"), 10_000) > 1


def test_declared_tables_and_statistics(spark):
    writers.create_databases(spark)
    for database in (STAGING, RESULTS):
        assert spark.catalog.databaseExists(database)
    names = writers.create_tables(spark)
    assert len(names) == 24
    seed.cdr(spark).withColumn("event_date", F.to_date("event_time")).write.mode("overwrite").insertInto("cellmart.cdr_sgi_raw")
    upkeep.analyze(spark, tables=("cdr_sgi_raw", "bts_master", "call_quality_kudu"))
    upkeep.analyze_partition(spark, "cdr_sgi_raw", "2026-08-03")
    assert "12 rows" in {r["col_name"]: r["data_type"] for r in upkeep.describe(spark, "cdr_sgi_raw").collect()}["Statistics"]
    assert [r[0] for r in upkeep.partitions(spark, "cdr_sgi_raw").collect()] == ["event_date=2026-08-03"]
    assert upkeep.list_tables(spark).count() >= 24
    columns = spark.table("cellmart.call_quality_kudu").columns
    assert columns == schema("call_quality_kudu").names


def test_compaction_sorts_a_bounded_share_per_task(spark, tmp_path, monkeypatch):
    """A table whose compressed files are small but whose rows are many is compacted by several tasks."""
    from cellmart import analogs
    from cellmart.plans import upkeep
    from cellmart.schemas import TABLES
    from cellmart.sources import writers

    path = str(tmp_path / "many")
    rows = analogs.cdr(spark, "/root/testdata/sf0.001").select(*TABLES["cdr_sgi"].schema.names)
    writers.overwrite_partitions(rows, path, "cdr_sgi")
    assert upkeep.compact(spark, path, "cdr_sgi", str(tmp_path / "one")) == 1
    monkeypatch.setattr(upkeep, "TASK_BYTES", upkeep.measured_bytes(rows) // 3 + 1)
    assert upkeep.compact(spark, path, "cdr_sgi", str(tmp_path / "few")) == 3
