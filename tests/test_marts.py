"""Marts kept by a stream: sums of batches equal one run over everything, whatever runs twice."""

import random

from pyspark.sql import functions as F

from cellmart.plans import bi
from cellmart.session import scratch_path
from cellmart.sources import readers, writers
from cellmart.streaming import marts

CALL = "call_id string, contract_id string, product_id string, call_start_dt string, drop_flag string, volte_flag string, base_date string"


def calls(rng, n):
    rows = []
    for i in range(n):
        day = rng.choice(["20251130", "20251201", "20251202"])
        start = rng.choice([f"{day}08{rng.randrange(60):02}00", f"{day}0859", None, "unreadable"])
        rows.append((f"c{i}", f"k{rng.randrange(6)}", f"p{rng.randrange(4)}", start, rng.choice("YN"), rng.choice("YN"), day))
    return rows


def dims(spark):
    contracts = spark.createDataFrame([(f"k{i % 5}",) for i in range(7)], "contract_id string")
    products = spark.createDataFrame([("p0", "Y"), ("p1", "Y"), ("p1", "Y"), ("p2", "N")], "product_id string, volte_eligible string")
    return [contracts, products]


def test_batches_that_run_again_add_nothing(spark, bag):
    rng, mart, path = random.Random(1), marts.MARTS["volte"], scratch_path(spark, "volte")
    rows, columns = calls(rng, 300), ["window_start", "drop_rate", "total_calls", "dropped_calls"]
    assert marts.read_mart(spark, mart, path, "R").collect() == []
    for batch in range(5):
        part = spark.createDataFrame(rows[60 * batch : 60 * batch + 60], CALL)
        for _ in range(2 if batch % 2 else 1):
            marts.add_batch(mart, part, dims(spark), path, batch)
        if batch == 2:
            marts.fold(spark, mart, path, 1)
            marts.fold(spark, mart, path, 0)
            # a batch that is folded already, and one that is not
            marts.add_batch(mart, spark.createDataFrame(rows[60:120], CALL), dims(spark), path, 1)
            marts.add_batch(mart, part, dims(spark), path, 2)
        so_far = bi.mart_volte(spark.createDataFrame(rows[: 60 * batch + 60], CALL), *dims(spark), "R")
        assert bag(marts.read_mart(spark, mart, path, "R"), *columns) == bag(so_far, *columns)
    marts.fold(spark, mart, path, 4)
    whole = marts.read_mart(spark, mart, path, "R")
    assert bag(whole, *columns) == bag(so_far, *columns)
    december = [repr(tuple(r[c] for c in columns)) for r in whole.collect() if r.window_start and r.window_start.month == 12]
    assert december and bag(marts.read_mart(spark, mart, path, "R", ["202512"]), *columns) == sorted(december)


def test_a_stream_goes_on_where_it_stopped(spark, bag):
    rng, mart = random.Random(2), marts.MARTS["volte"]
    rows, columns = calls(rng, 120), ["window_start", "drop_rate", "total_calls", "dropped_calls"]
    source, path, state = (scratch_path(spark, x) for x in ("calls", "mart", "state"))
    for part in (rows[:70], rows[70:]):
        spark.createDataFrame(part, CALL).repartition(2).write.mode("append").parquet(source)
        facts = spark.readStream.schema(CALL).option("maxFilesPerTrigger", 1).parquet(source)
        marts.keep_mart(mart, facts, dims(spark), path, state, fold_every=3, available_now=True).awaitTermination()
    whole = bi.mart_volte(spark.createDataFrame(rows, CALL), *dims(spark), "R")
    assert bag(marts.read_mart(spark, mart, path, "R"), *columns) == bag(whole, *columns)
    assert marts._base(spark, path)[1] == 2


def test_every_slice_is_copied_and_a_copy_starts_again(spark, bag):
    rows = [(f"s{i}", "c", None, "20251201000000", f"202512{1 + i % 9:02}", "x", i, "S1AP", "Y", "u", None) for i in range(60)]
    fields = {f.name: f.dataType.simpleString() for f in readers.schema("cdr_sgi").fields}
    made = [tuple(dict(zip(["sgi_id", "cell_id", "alt_cell_id", "rqt_st_dt", "etl_date", "base_date", "val", "signal_type", "use_flag", "subscriber_id"], r)).get(c) for c in fields) for r in rows]  # noqa: B905
    source = spark.createDataFrame(made, readers.schema("cdr_sgi"))
    path = scratch_path(spark, "slices")
    for _ in range(2):
        writers.ingest_slices(spark, source, path, "cdr_sgi", at_once=4)
    assert bag(readers.read_table(spark, path, "cdr_sgi"), "sgi_id", "etl_date", "val") == bag(source, "sgi_id", "etl_date", "val")
    some = readers.read_days(spark, path, "cdr_sgi", ["20251203", "20990101"])
    assert bag(some, "sgi_id", "etl_date") == bag(source.where("etl_date = '20251203'"), "sgi_id", "etl_date")
    assert readers.read_days(spark, path, "cdr_sgi", ["20990101"]).collect() == []


def test_a_kept_mart_takes_batches_of_several_files(spark, monkeypatch):
    """The facts of a batch lie in as many files as there are tasks, so no task holds a fourth of them all."""
    import __spark_entry__ as entry

    seen, add = [], marts.add_batch
    monkeypatch.setattr(entry.marts, "add_batch", lambda mart, rows, *rest: (seen.append(rows.select(F.input_file_name()).distinct().count()), add(mart, rows, *rest)))
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        rows = entry.q_mart_volte_incremental(spark, "/root/testdata/sf0.001").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert rows and sorted(set(seen)) == [3]
