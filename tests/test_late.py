"""Late rows: told apart by the newest event of earlier batches, once per batch, rows without a time included."""

import datetime as dt
import random

from cellmart.session import scratch_path
from cellmart.streaming import late, windows

BASE = dt.datetime(2025, 12, 1, 8, 0)
FIELDS = "cell_id string, rqt_st_dt string, val long, event_time timestamp"


def test_late_rows_and_corrected_windows(spark, bag):
    rng, source, path, state = random.Random(3), *(scratch_path(spark, x) for x in ("arrivals", "sorted", "state"))
    stations = spark.createDataFrame([("a", "bts1", "r"), ("b", "bts2", None)], "cell_id string, bts_alt_key string, region_cd string")
    mark, every, expected = None, [], []
    for batch in range(4):
        rows = [(rng.choice("abc"), "20251201004500", i, BASE + dt.timedelta(seconds=rng.randrange(900) + 400 * batch)) for i in range(60)]
        rows.append((None, None, 1, None))
        every += rows
        for r in rows:
            if mark and r[3] and r[3] - dt.timedelta(minutes=r[3].minute % 5, seconds=r[3].second) + dt.timedelta(minutes=5, seconds=10) <= mark:
                expected.append((*r, batch))
        spark.createDataFrame(rows, FIELDS).coalesce(1).write.mode("append").parquet(source)
        facts = spark.readStream.schema(FIELDS).parquet(source)
        # stopped and started again between the batches
        late.sort_out(facts, path, state, available_now=True).awaitTermination()
        mark = max([r[3] for r in every if r[3]])
    fields = facts.schema
    found = late.late_rows(spark, path, fields)
    assert bag(found) == sorted(map(repr, expected)) and len(expected) > 10
    assert late.stored_rows(spark, path, fields).count() == len(every)
    assert sum(r.late_cnt for r in late.late_counts(spark, path, fields).collect()) == len(expected)
    on_time = late.stored_rows(spark, path, fields).where("late = 'false'").select(*fields.names)
    both = late.corrected(windows.ltas(on_time, stations), windows.ltas(found.select(*fields.names), stations))
    assert bag(both) == bag(windows.ltas(spark.createDataFrame(every, FIELDS).where("event_time IS NOT NULL"), stations).select(*both.columns))


def test_a_batch_that_runs_again_is_stored_once(spark):
    path, rows = scratch_path(spark, "sorted"), spark.range(5).selectExpr("'a' AS cell_id", "timestamp_seconds(id) AS event_time")
    source = scratch_path(spark, "rows")
    rows.write.parquet(source)
    for _ in range(2):
        # a new checkpoint numbers its batches from the start, like one that was not finished
        facts = spark.readStream.schema(rows.schema).parquet(source)
        late.sort_out(facts, path, scratch_path(spark, "state"), available_now=True).awaitTermination()
    assert late.stored_rows(spark, path, rows.schema).count() == 5
