
from __future__ import annotations

import math
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart import analogs as a
from cellmart.operators.grid_join import grid_join
from cellmart.operators.or_join import or_bridge, or_join, or_weights, through_bridge
from cellmart.operators.pit_join import pit_join, with_validity
from cellmart.operators.upsert import upsert
from cellmart.functions.geo import with_segments
from cellmart.functions import predicates
from cellmart.functions.predicates import LINE_CNT_METRES, SIGNALS, USE_FLAGS
from cellmart.plans import audit, batch, bi, conform, daily, lookup, upkeep
from cellmart.schemas import TABLES
from cellmart.session import scratch_path, shared_dir, stored
from cellmart.sources import keyed, located, readers, writers
from cellmart.streaming import alerts, jobs, late, marts, windows

try:
    import corpus_pipeline
    from cellmart.llm import entry as corpus
except ModuleNotFoundError as missing:  # the corpus operators may be left out; what they need may not
    if missing.name not in ("corpus_pipeline", "cellmart.llm"):
        raise
    corpus_pipeline = corpus = None

Query = Callable[[SparkSession, str], DataFrame]

SAMPLE_DIR = "/root/testdata/sf0.001"
# the key columns whose statistics are kept
STATISTICS = {t: [c for c in dict.fromkeys([TABLES[t].sort_by, TABLES[t].bucket_by, *TABLES[t].key]) if c] for t in ("cdr_sgi_raw", "bts_master")}
# stations, or dated ones, for each partition of a stream's state
STATE_STATIONS, STATE_VERSIONS = 5_000, 20_000
# micro-batches that a kept mart takes its facts in
MART_BATCHES = 4
UPSERT_ORDER = ["base_date", "call_id", "rsrp", "rsrq", "drop_flag", "detail_json"]


def _plain(df: DataFrame) -> DataFrame:
    """Wall-clock timestamps without zone, the same in every reader."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType) else f.name
            for f in df.schema.fields
        ]
    )


# ---- batch and BI ---------------------------------------------------------


def q_ltas_hourly(spark: SparkSession, d: str) -> DataFrame:
    return batch.ltas_hourly(a.cdr(spark, d), a.bts(spark, d))


def q_sgi_use_v1(spark: SparkSession, d: str) -> DataFrame:
    return batch.sgi_use_by_cell(a.cdr(spark, d), a.bts(spark, d))


def q_sgi_use_v2(spark: SparkSession, d: str) -> DataFrame:
    return batch.sgi_use_by_station(a.cdr(spark, d), a.bts(spark, d))


def q_mdt_merge(spark: SparkSession, d: str) -> DataFrame:
    merged = batch.mdt_merge(a.mdt(spark, d), a.bts(spark, d), a.rpot(spark, d))
    return merged.withColumn("distance_m", F.round("distance_m", 6))


def q_grid_join(spark: SparkSession, d: str) -> DataFrame:
    """Every measurement with each reporting line of its vendor it is close to."""
    reach = (F.col("rpot_line_cnt") * LINE_CNT_METRES).alias("reach")
    lines = with_segments(a.rpot(spark, d).select("bts_market_nm", "rpot_seq", "rpot_geom", reach), "rpot_geom")
    points = a.mdt(spark, d).select("mdt_id", "gnss_utmkx", "gnss_utmky", "bts_market_nm")
    return grid_join(points, lines, ["bts_market_nm"], "gnss_utmkx", "gnss_utmky")


# metres: west, south, east, north
BOX = (200.0, 100.0, 600.0, 400.0)


def q_points_in_box(spark: SparkSession, d: str) -> DataFrame:
    """Measurements in a box, from a table laid out by both coordinates."""

    def build(name: str) -> None:
        located.write_located(a.mdt(spark, d), f"{shared_dir(spark)}/{name}", "gnss_utmkx", "gnss_utmky")

    table = spark.read.parquet(f"{shared_dir(spark)}/{_once(spark, 'located', d, build)}")
    found = located.points_in_box(table, "gnss_utmkx", "gnss_utmky", *BOX)
    return found.select("mdt_id", "gnss_utmkx", "gnss_utmky", "bts_market_nm", "rsrp")


def _stations(spark: SparkSession, d: str) -> DataFrame:
    return a.bts(spark, d).select("cell_id", "alt_cell_id", "bts_alt_key", "region_cd")


def _or_join(how: str, spark: SparkSession, d: str) -> DataFrame:
    records = a.cdr(spark, d).select("sgi_id", "cell_id", "alt_cell_id")
    return or_join(records, _stations(spark, d), how)


def q_or_bridge(spark: SparkSession, d: str) -> DataFrame:
    return or_bridge(a.cdr(spark, d), _stations(spark, d))


def q_through_bridge(spark: SparkSession, d: str) -> DataFrame:
    """The OR join through its stored matches of key pairs."""
    records = a.cdr(spark, d).select("sgi_id", "cell_id", "alt_cell_id")
    return through_bridge(records, stored(or_bridge(records, _stations(spark, d)), "bridge"))


def q_or_weights(spark: SparkSession, d: str) -> DataFrame:
    """The stored form of the OR join: weights per key and region."""
    return or_weights(a.bts(spark, d), ["region_cd"]).drop("d_leg")


def q_rsrp_bad_rate(spark: SparkSession, d: str) -> DataFrame:
    return bi.rsrp_bad_rate(a.mdt(spark, d), a.gpot(spark, d), a.bdri(spark, d))


def q_volte_drop(spark: SparkSession, d: str) -> DataFrame:
    return bi.volte_drop(a.calls(spark, d), a.contracts(spark, d), a.products(spark, d))


def q_partition_count(spark: SparkSession, d: str) -> DataFrame:
    return bi.partition_count(a.cdr(spark, d), "Q3")


def q_region_total(spark: SparkSession, d: str) -> DataFrame:
    return bi.region_total(a.cdr(spark, d), a.bts(spark, d), "Q4")


def q_mart_rsrp(spark: SparkSession, d: str) -> DataFrame:
    return bi.mart_rsrp(a.mdt(spark, d), a.gpot(spark, d), a.bdri(spark, d), "R1")


def q_mart_volte(spark: SparkSession, d: str) -> DataFrame:
    return _plain(bi.mart_volte(a.calls(spark, d), a.contracts(spark, d), a.products(spark, d), "R1"))


# ---- lookups and upsert ---------------------------------------------------

_MADE: dict[tuple[str, ...], str] = {}


def _once(spark: SparkSession, what: str, d: str, build: Callable[[str], None]) -> str:
    """The name of a table that lookups and checks read, built at its first use in an application."""
    key = (spark.sparkContext.applicationId, what, d)
    if key not in _MADE:
        name = f"{what}_{uuid.uuid4().hex}"
        build(name)
        _MADE[key] = name
    return _MADE[key]


def _keyed(spark: SparkSession, d: str, table: str) -> DataFrame:
    """A keyed table stored in its buckets, read through the catalog. A name of its own keeps runs apart."""

    def build(name: str) -> None:
        rows = a.quality(spark, d)
        rows = lookup.quality_by_call(rows) if table == "call_quality_kudu_by_call" else rows
        writers.write_bucketed(rows, table, name, path=scratch_path(spark, name))

    return spark.table(_once(spark, table, d, build))


def _dated(spark: SparkSession, d: str) -> str:
    """Where the table partitioned by day is."""

    def build(name: str) -> None:
        writers.write_clustered(a.quality(spark, d), f"{shared_dir(spark)}/{name}", "call_quality_iceberg")

    return f"{shared_dir(spark)}/{_once(spark, 'dated', d, build)}"


def q_lookup_hash(spark: SparkSession, d: str) -> DataFrame:
    return lookup.by_key(_keyed(spark, d, "call_quality_kudu"), "LOOKUP_KEY_00001")


def q_lookup_filtered(spark: SparkSession, d: str) -> DataFrame:
    """A call, and a call and a key that do not exist, in the table that is laid out by another key."""
    table = _keyed(spark, d, "call_quality_kudu")
    asked = [{"call_id": "CALL_00099"}, {"call_id": "CALL_00099x"}, {"lookup_key": "LOOKUP_KEY_00001x"}]
    return reduce(DataFrame.unionByName, [lookup.by_other_key(table, **x) for x in asked])


def q_lookup_part(spark: SparkSession, d: str) -> DataFrame:
    """One key of the day that holds the first order, in the table partitioned by day."""
    day = spark.read.parquet(f"{d}/orders.parquet").where("o_orderkey = 1").agg(F.max("o_orderdate")).first()[0]
    table = readers.read_days(spark, _dated(spark, d), "call_quality_iceberg", [f"{day:%Y%m%d}"])
    return lookup.by_key_and_date(table, "LOOKUP_KEY_00001", f"{day:%Y%m%d}")


def q_lookup_by_call(spark: SparkSession, d: str) -> DataFrame:
    return lookup.by_call(_keyed(spark, d, "call_quality_kudu_by_call"), "CALL_00099", "19960101", "19991231")


def q_lookup_batch(spark: SparkSession, d: str) -> DataFrame:
    keys = spark.read.parquet(f"{d}/events.parquet").select(
        F.format_string("LOOKUP_KEY_%05d", F.col("event_id") * 2).alias("lookup_key")
    )
    return lookup.by_keys(a.quality(spark, d), keys)


def q_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The nightly change set merged into the stored keyed table."""
    base = _keyed(spark, d, "call_quality_kudu")
    return upsert(base, a.quality_changes(spark, d), ["lookup_key"], UPSERT_ORDER)


def q_published_upsert(spark: SparkSession, d: str) -> DataFrame:
    """The merged table as a new version behind a catalog view, read through the view."""
    view = f"quality_{uuid.uuid4().hex}"
    base = _keyed(spark, d, "call_quality_kudu")
    writers.publish_upsert(spark, base, a.quality_changes(spark, d), ["lookup_key"], UPSERT_ORDER, view)
    return spark.table(view)


def q_upsert_delta(spark: SparkSession, d: str) -> DataFrame:
    """The change set in three parts as delta files; the buckets with many changes are folded after the second, the last part comes twice."""
    fields = a.quality(spark, d).select(*lookup.QUALITY).schema
    store = keyed.KeyedStore(spark, scratch_path(spark, "quality"), fields, "lookup_key", UPSERT_ORDER, buckets=16)
    store.create(a.quality(spark, d))
    changes = a.quality_changes(spark, d).select(*lookup.QUALITY)
    for seq in (0, 1, 2, 2):
        store.apply(changes.where(F.pmod(F.xxhash64(*lookup.QUALITY), F.lit(3)) == seq), seq)
        if seq == 1:
            store.fold(changes.count() // 24)
    return store.read()


# ---- stored tables --------------------------------------------------------


def _written(spark: SparkSession, table: str, *parts: DataFrame) -> DataFrame:
    """A table written part by part, each replacing the partitions it holds, and read back."""
    path = scratch_path(spark, table)
    for rows in parts:
        writers.overwrite_partitions(rows.select(*TABLES[table].schema.names), path, table)
    return readers.read_table(spark, path, table)


def _last_day(spark: SparkSession, d: str):
    return spark.read.parquet(f"{d}/events.parquet").agg(F.max("ts")).first()[0]


def q_stored_days(spark: SparkSession, d: str) -> DataFrame:
    """All days of the records stored, the last one replaced by doubled values; rows per day of the whole table."""
    records = a.cdr(spark, d)
    again = records.where(F.col("etl_date") == f"{_last_day(spark, d):%Y%m%d}").withColumn("val", F.col("val") * 2)
    stored = _written(spark, "cdr_sgi", records, again)
    return stored.groupBy("etl_date").agg(F.count(F.lit(1)).alias("row_cnt"), F.sum("val").alias("total_val"))


def q_stored_day(spark: SparkSession, d: str) -> DataFrame:
    """The month of the last event, by the prefix of its partition values, and in it the last day by its partition."""
    last = _last_day(spark, d)
    stored = _written(spark, "cdr_sgi", a.cdr(spark, d)).where(F.col("etl_date").startswith(f"{last:%Y%m}"))
    return predicates.on_days(stored, "etl_date", f"{last:%Y%m%d}").select("sgi_id", "cell_id", "val", "etl_date")


def q_ingested_slices(spark: SparkSession, d: str) -> DataFrame:
    """Every day of a stored raw table, copied slice by slice into another."""
    source = _written(spark, "cdr_sgi_raw", a.cdr(spark, d))
    path = scratch_path(spark, "slices")
    writers.ingest_slices(spark, source, path, "cdr_sgi_raw")
    copied = readers.read_table(spark, path, "cdr_sgi_raw")
    return copied.select("sgi_id", "cell_id", "val", F.col("event_date").cast("string").alias("event_date"))


def q_loaded_drop(spark: SparkSession, d: str) -> DataFrame:
    """A raw drop with nanosecond times as whole numbers and a dimension with its own file schema, loaded twice after a
    purge: facts are appended, the dimension is replaced."""
    staging, house = scratch_path(spark, "staging"), scratch_path(spark, "house")
    nanos = (F.unix_micros("event_time") * 1000 + 999).alias("event_time")
    for name, rows in (("cdr_sgi_raw", a.cdr(spark, d)), ("cdr_mdt_smsng_raw", a.mdt_raw(spark, d))):
        rows = rows.select(*TABLES[name].schema.names)
        rows.select(*rows.drop("event_time").columns, nanos).write.parquet(f"{staging}/{name}.parquet")
        writers.append(rows, f"{house}/{name}", name)
        writers.reload(rows.where("mdt_id = '1'" if "mdt_id" in rows.columns else "sgi_id = '1'"), f"{house}/{name}", name)
    a.bts(spark, d).write.parquet(f"{staging}/bts_master.parquet")
    for _ in range(2):
        writers.load_drop(spark, staging, house)

    def counted(name: str) -> DataFrame:
        rows = readers.read_table(spark, f"{house}/{name}", name)
        newest = F.max("event_time") if "event_time" in rows.columns else F.lit(None).cast("timestamp")
        return rows.agg(F.count(F.lit(1)).alias("row_cnt"), newest.alias("newest")).select(F.lit(name).alias("tbl"), "*")

    return _plain(reduce(DataFrame.unionByName, [counted(n) for n in ("cdr_sgi_raw", "cdr_mdt_smsng_raw", "bts_master")]))


def q_seed_csv(spark: SparkSession, d: str) -> DataFrame:
    """The stations written as CSV with a header and read back with their types; empty text stays empty."""
    path = scratch_path(spark, "seed")
    rows = a.bts(spark, d).withColumn("region_cd", F.when(F.col("rpot_line_cnt") > 10, F.col("region_cd")).otherwise(""))
    rows = rows.withColumn("alt_cell_id", F.when(F.col("rpot_line_cnt") != 1, F.col("alt_cell_id")))
    rows.write.option("header", True).option("emptyValue", '""').option("nullValue", "\\N").csv(path)
    return readers.read_seed(spark, path, "bts_master").select("cell_id", "alt_cell_id", "bts_alt_key", "region_cd", "rpot_line_cnt")


def q_compacted(spark: SparkSession, d: str) -> DataFrame:
    """A table written in many files, compacted into few clustered ones."""
    path, out = scratch_path(spark, "many"), scratch_path(spark, "few")
    records = a.cdr(spark, d).select(*TABLES["cdr_sgi"].schema.names)
    writers.overwrite_partitions(records.repartition(8), path, "cdr_sgi")
    upkeep.compact(spark, path, "cdr_sgi", out)
    rows = readers.read_table(spark, out, "cdr_sgi")
    return rows.groupBy("etl_date", "cell_id").agg(F.count(F.lit(1)).alias("row_cnt"), F.sum("val").alias("total_val"))


def _database(spark: SparkSession, d: str) -> str:
    """A database with the raw records and the stations, declared and filled."""
    name = f"upkeep_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    for table, rows in (("cdr_sgi_raw", a.cdr(spark, d)), ("bts_master", a.bts(spark, d))):
        spec = TABLES[table]
        path = scratch_path(spark, table)
        writers.append(rows.select(*spec.schema.names), path, table)
        writers.create_table(spark, table, name, path)
    upkeep.analyze(spark, name, ("cdr_sgi_raw", "bts_master"))
    return name


def q_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Rows and NULL keys as the catalog knows them after statistics were collected."""
    return upkeep.statistics(spark, _database(spark, d), ("cdr_sgi_raw", "bts_master"))


def q_partitions(spark: SparkSession, d: str) -> DataFrame:
    """The partitions that the catalog has found behind a table."""
    return upkeep.partitions(spark, "cdr_sgi_raw", _database(spark, d))


def _mart(spark: SparkSession, table: str, runs: dict[str, DataFrame], order: tuple[str, ...]) -> DataFrame:
    """Runs stored one after the other; the mart as it is after the last."""
    tables = daily.Warehouse(spark, scratch_path(spark, "marts"))
    for run_id in order:
        daily.store_run(tables, table, batch.stamped(runs[run_id], "computed_at"), run_id)
    return tables.read(table).select(*[c for c in TABLES[table].schema.names if c != "computed_at"])


def q_mart_rsrp_stored(spark: SparkSession, d: str) -> DataFrame:
    runs = {r: bi.mart_rsrp(a.mdt(spark, d), a.gpot(spark, d), a.bdri(spark, d), r) for r in ("R1", "R2")}
    return _mart(spark, "mstr_rsrp_bad_rate_result", runs, ("R1", "R2"))


def q_mart_volte_stored(spark: SparkSession, d: str) -> DataFrame:
    """Two runs over the same windows, calls of the first product with unreadable starts among them."""
    started = F.when(F.col("product_id") == "1", "unreadable").otherwise(F.col("call_start_dt"))
    records = a.calls(spark, d).withColumn("call_start_dt", started)
    runs = {r: bi.mart_volte(records, a.contracts(spark, d), a.products(spark, d), r) for r in ("R1", "R2")}
    return _plain(_mart(spark, "mstr_volte_drop_result", runs, ("R1", "R2")))


def _kept_mart(name: str, facts: DataFrame, dims: list[DataFrame]) -> DataFrame:
    """The mart after all facts came in MART_BATCHES batches of files, folded on the way; the second batch runs twice."""
    spark, mart = facts.sparkSession, marts.MARTS[name]
    source, path = scratch_path(spark, "facts"), scratch_path(spark, name)
    # as many files as shuffles have tasks, so that a task's share stays small
    tasks = max(MART_BATCHES, int(spark.conf.get("spark.sql.shuffle.partitions")))
    facts.repartition(tasks, *facts.columns).write.parquet(source)
    at_once = math.ceil(len(spark.read.schema(facts.schema).parquet(source).inputFiles()) / MART_BATCHES)
    stream = spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", max(at_once, 1)).parquet(source)
    replayed: list[int] = []

    def run(rows: DataFrame, batch: int) -> None:
        for _ in range(2 if batch == 1 else 1):
            marts.add_batch(mart, rows, dims, path, batch)
            replayed.append(batch)
        if batch == 1:
            marts.fold(spark, mart, path, batch)
            # again, after it is folded
            marts.add_batch(mart, rows, dims, path, batch)

    writer = stream.writeStream.foreachBatch(run).option("checkpointLocation", scratch_path(spark, "batches"))
    writer.trigger(availableNow=True).start().awaitTermination()
    if facts.limit(1).count() and replayed.count(1) != 2:
        raise RuntimeError("the second batch did not run again")
    return marts.read_mart(spark, mart, path, "R1")


def q_mart_volte_incremental(spark: SparkSession, d: str) -> DataFrame:
    return _plain(_kept_mart("volte", a.calls(spark, d), [a.contracts(spark, d), a.products(spark, d)]))


def q_mart_rsrp_incremental(spark: SparkSession, d: str) -> DataFrame:
    return _kept_mart("rsrp", a.mdt(spark, d), [a.gpot(spark, d), a.bdri(spark, d)])


# ---- windows --------------------------------------------------------------

_FACTS = {"ltas": a.cdr, "sgi_v1": a.cdr, "sgi_v2": a.cdr, "mdt": a.mdt_raw}
_CORES = {"ltas": windows.ltas, "sgi_v1": windows.sgi_v1, "sgi_v2": windows.sgi_v2, "mdt": windows.mdt}


def _window(job: str, minute: str | None, spark: SparkSession, d: str) -> DataFrame:
    return _plain(_CORES[job](_FACTS[job](spark, d), a.bts(spark, d), minute))


def _events(spark: SparkSession, d: str) -> DataFrame:
    """The events file as a stream."""
    fields = spark.read.parquet(f"{d}/events.parquet").schema
    return spark.readStream.schema(fields).option("pathGlobFilter", "events.parquet").parquet(d)


def _started(job: str, minute: str | None, spark: SparkSession, d: str, sink: str, versions: DataFrame | None = None):
    """The job as a stream over the events file, which ends when it is drained."""
    facts = (a.mdt_raw_of if job == "mdt" else a.cdr_of)(_events(spark, d))
    state = scratch_path(spark, f"state-{job}")
    stations = a.bts(spark, d) if versions is None else versions
    result = jobs.closed_windows(job, facts, stations, minute=minute, versioned=versions is not None)
    # a window holds a row for every station, or version in force, of its vendors
    held = math.ceil(stations.count() / (STATE_STATIONS if versions is None else STATE_VERSIONS))
    parts = max(spark.sparkContext.defaultParallelism, held)
    return jobs.write_windows(result, sink, state, available_now=True, state_partitions=parts)


def _streamed(job: str, minute: str | None, spark: SparkSession, d: str, versions: DataFrame | None = None) -> DataFrame:
    sink = scratch_path(spark, f"sink-{job}")
    _started(job, minute, spark, d, sink, versions).awaitTermination()
    return jobs.read_sink(spark, job, sink)


def _drained(spark: SparkSession, d: str, minutes: dict[str, str | None]) -> dict[str, str]:
    """The sinks of the jobs, whose streams run side by side at their first use in an application."""
    app, shared, running = spark.sparkContext.applicationId, shared_dir(spark), []
    for job, minute in minutes.items():
        key = (app, f"sink-{job}-{minute}", d)
        if key not in _MADE:
            _MADE[key] = f"sink-{job}_{uuid.uuid4().hex}"
            running.append((key, _started(job, minute, spark, d, f"{shared}/{_MADE[key]}")))
    for key, query in running:
        try:
            query.awaitTermination()
        except Exception:
            _MADE.pop(key, None)
            raise
    return {job: f"{shared}/{_MADE[(app, f'sink-{job}-{minute}', d)]}" for job, minute in minutes.items()}


def _stream(job: str, spark: SparkSession, d: str) -> DataFrame:
    return _plain(_streamed(job, windows.MINUTE, spark, d))


def q_tail_restart(spark: SparkSession, d: str) -> DataFrame:
    """A job that tails its raw table: drained, stopped, and started again with its checkpoint after the later half has arrived."""
    records = a.cdr(spark, d)
    ends = records.agg(F.min("event_time").alias("low"), F.max("event_time").alias("high")).first()
    if ends["low"] is None:
        return _stream("ltas", spark, d)
    half = ends["low"] + (ends["high"] - ends["low"]) / 2
    raw, sink, state = (scratch_path(spark, x) for x in ("raw", "sink", "state"))
    for part in (F.col("event_time") <= half, F.col("event_time") > half):
        writers.append(records.where(part).select(*TABLES["cdr_sgi_raw"].schema.names), raw, "cdr_sgi_raw")
        jobs.start(
            spark, "ltas", raw, a.bts(spark, d), sink, state, available_now=True, state_partitions=spark.sparkContext.defaultParallelism
        ).awaitTermination()
    return _plain(jobs.read_sink(spark, "ltas", sink))


def _sorted_out(spark: SparkSession, d: str) -> tuple[str, T.StructType]:
    """Call records that come in four batches, each over the whole time, so that all but the first are mostly late."""
    events = spark.read.parquet(f"{d}/events.parquet")
    source, path = scratch_path(spark, "arrivals"), scratch_path(spark, "sorted-out")
    for k in range(4):
        events.where(F.col("event_id") % 4 == k).coalesce(1).write.mode("append").parquet(source)
    rows = a.cdr_of(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(source))
    late.sort_out(rows, path, scratch_path(spark, "state"), available_now=True).awaitTermination()
    return path, rows.schema


def q_stream_late_rows(spark: SparkSession, d: str) -> DataFrame:
    return _plain(late.late_counts(spark, *_sorted_out(spark, d)))


def q_stream_late_corrected(spark: SparkSession, d: str) -> DataFrame:
    """Closed windows of a job over the rows in time, corrected by the late ones: as if none had been late."""
    path, fields = _sorted_out(spark, d)
    result = jobs.closed_windows("ltas", late.in_time(spark, path, fields), a.bts(spark, d))
    sink = scratch_path(spark, "sink")
    cores = spark.sparkContext.defaultParallelism
    jobs.write_windows(result, sink, scratch_path(spark, "state"), available_now=True, state_partitions=cores).awaitTermination()
    missed = windows.ltas(late.late_rows(spark, path, fields), a.bts(spark, d))
    return _plain(late.corrected(jobs.read_sink(spark, "ltas", sink), missed))


def q_pit_join(spark: SparkSession, d: str) -> DataFrame:
    versions = with_validity(a.station_versions(spark, d), "cell_id")
    records = a.cdr(spark, d).select("sgi_id", "cell_id", "event_time")
    return _plain(pit_join(records, versions, "cell_id"))


def _versions(spark: SparkSession, d: str) -> DataFrame:
    """Dated stations with their vendors and alternate cells."""
    dated = a.station_versions(spark, d)
    vendor = F.element_at(F.array(*map(F.lit, ("SAMSUNG", "ERICSSON", "NOKIA"))), (F.col("cell_id").cast("long") % 3 + 1).cast("int"))
    # four cells share an alternate one, as in the stations without dates
    other = F.floor(F.col("cell_id").cast("long") / 4).cast("string")
    # stored, since jobs read them several times
    return stored(with_validity(dated.withColumns({"bts_market_nm": vendor, "alt_cell_id": other}), "cell_id"), "versions")


def _win_versioned(job: str, spark: SparkSession, d: str) -> DataFrame:
    return _plain(jobs.VERSIONED[job](_FACTS[job](spark, d), _versions(spark, d)))


def _stream_versioned(job: str, spark: SparkSession, d: str) -> DataFrame:
    return _plain(_streamed(job, windows.MINUTE, spark, d, versions=_versions(spark, d)))


def q_win_ltas_versioned(spark: SparkSession, d: str) -> DataFrame:
    versions = with_validity(a.station_versions(spark, d), "cell_id")
    return _plain(windows.ltas_versioned(a.cdr(spark, d), versions, None))


# ---- conforming -----------------------------------------------------------


def q_fk_repair(spark: SparkSession, d: str) -> DataFrame:
    return conform.repair_keys(a.cdr(spark, d).select("sgi_id", "cell_id", "alt_cell_id"), a.bts(spark, d))


def q_domain_repair(spark: SparkSession, d: str) -> DataFrame:
    records = a.cdr(spark, d).select("sgi_id", "signal_type", "use_flag")
    repaired = conform.repair_domain(records, "signal_type", SIGNALS, "sgi_id")
    return conform.repair_domain(repaired, "use_flag", USE_FLAGS, "sgi_id")


def q_clip_fill(spark: SparkSession, d: str) -> DataFrame:
    raw = a.mdt_raw(spark, d).select("mdt_id", "gnss_utmkx", "gnss_utmky")
    clipped = conform.clip_fill(raw, "gnss_utmkx", conform.X_DEFAULT, conform.X_LOW, conform.X_HIGH)
    return conform.clip_fill(clipped, "gnss_utmky", conform.Y_DEFAULT, conform.Y_LOW, conform.Y_HIGH)


def q_time_keys(spark: SparkSession, d: str) -> DataFrame:
    return conform.time_keys(a.cdr(spark, d).select("sgi_id", "event_time")).drop("event_time")


def q_row_ids(spark: SparkSession, d: str) -> DataFrame:
    records = a.cdr(spark, d).select(F.col("sgi_id").alias("source_id"), "sgi_id", "event_time")
    return conform.row_ids(records, "sgi_id", "SGI", ["event_time"]).drop("event_time")


def q_dim_expand(spark: SparkSession, d: str) -> DataFrame:
    index = spark.read.parquet(f"{d}/customer.parquet").select(F.col("c_custkey").alias("i"))
    return conform.stations_from_index(index)


def q_load_summary(spark: SparkSession, d: str) -> DataFrame:
    return conform.load_summary(
        {"bts_master": a.bts(spark, d), "cdr_sgi_raw": a.cdr(spark, d), "cdr_mdt_smsng_raw": a.mdt_raw(spark, d)}
    )


# ---- audits ---------------------------------------------------------------


def q_row_count_audit(spark: SparkSession, d: str) -> DataFrame:
    def counted(name: str, source: str) -> DataFrame:
        rows = spark.read.parquet(f"{d}/{source}.parquet")
        return rows.agg(F.count(F.lit(1)).alias("expected")).select(F.lit(name).alias("tbl"), "expected")

    expected = counted("cdr_sgi", "events").unionByName(counted("bts_master", "customer"))
    tables = {"cdr_sgi": a.cdr(spark, d), "bts_master": a.bts(spark, d), "cdr_mdt_smsng": a.mdt(spark, d)}
    return audit.row_count_audit(tables, expected)


def q_eligible_counts(spark: SparkSession, d: str) -> DataFrame:
    return audit.eligible_counts({"cdr_sgi_raw": a.cdr(spark, d), "cdr_mdt_smsng_raw": a.mdt_raw(spark, d)})


# the first job over every minute, the others with the filter they run with
_PARITY_MINUTE = {"ltas": None, "sgi_v1": windows.MINUTE, "sgi_v2": windows.MINUTE, "mdt": windows.MINUTE}


def q_stream_batch_parity(spark: SparkSession, d: str) -> DataFrame:
    """All windows of each batch core against those its stream has closed."""
    parts, sinks = [], _drained(spark, d, _PARITY_MINUTE)
    for job, minute in _PARITY_MINUTE.items():
        expected = _CORES[job](_FACTS[job](spark, d), a.bts(spark, d), minute)
        on = [c for c in expected.columns if c not in ("total_val", "record_cnt")]
        compared = audit.parity(expected, jobs.read_sink(spark, job, sinks[job]), on, ["record_cnt"])
        parts.append(audit.parity_summary(job, compared))
    return reduce(DataFrame.unionByName, parts)


def q_parity_digests(spark: SparkSession, d: str) -> DataFrame:
    """The keys in which a batch core and its stream differ, from digests: the windows the stream has not closed."""
    parts, sinks = [], _drained(spark, d, {"ltas": None, "mdt": windows.MINUTE})
    for job, minute in (("ltas", None), ("mdt", windows.MINUTE)):
        expected = stored(_CORES[job](_FACTS[job](spark, d), a.bts(spark, d), minute), "expected")
        on = [c for c in expected.columns if c not in ("total_val", "record_cnt")]
        found = audit.parity_digests(expected, jobs.read_sink(spark, job, sinks[job]), on, ["record_cnt"])
        parts.append(found.select(F.lit(job).alias("job"), "window_start", "bts_alt_key", "batch_record_cnt", "stream_record_cnt", "side"))
    return _plain(reduce(DataFrame.unionByName, parts))


def _sinks(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """What each job has written to its sink."""
    sinks = _drained(spark, d, dict.fromkeys(_CORES, windows.MINUTE))
    return {jobs.JOBS[job][2]: jobs.read_sink(spark, job, sinks[job]) for job in _CORES}


def q_latest_windows(spark: SparkSession, d: str) -> DataFrame:
    """The newest rows of what each job has written, read from the newest days that hold as many."""
    newest, sinks = 10, _drained(spark, d, dict.fromkeys(_CORES, windows.MINUTE))
    rows = {jobs.JOBS[j][2]: jobs.read_sink(spark, j, path, jobs.newest_days(spark, j, path, newest)) for j, path in sinks.items()}
    return _plain(audit.latest_windows(rows, newest))


def q_window_checks(spark: SparkSession, d: str) -> DataFrame:
    """Per sink: rows with a wrong window, and rows in windows without an eligible source row."""

    def check(name: str, sink: DataFrame, facts: DataFrame) -> DataFrame:
        kinds = {"bad_window": audit.window_violations(sink), "bad_filter": audit.filter_violations(sink, facts)}
        return reduce(
            DataFrame.unionByName,
            [
                rows.agg(F.count(F.lit(1)).alias("violations")).select(
                    F.lit(name).alias("tbl"), F.lit(kind).alias("kind"), "violations"
                )
                for kind, rows in kinds.items()
            ],
        )

    sinks = _sinks(spark, d)
    return reduce(
        DataFrame.unionByName,
        [check(jobs.JOBS[job][2], sinks[jobs.JOBS[job][2]], _FACTS[job](spark, d)) for job in _CORES],
    )


def q_latency_summary(spark: SparkSession, d: str) -> DataFrame:
    rounded = [F.round(c, 6).alias(c) for c in ("avg_sec", "p95_sec", "p99_sec")]
    return audit.latency_summary(a.timings(spark, d)).select("engine", "n", "max_sec", *rounded)


def q_latency_alerts(spark: SparkSession, d: str) -> DataFrame:
    alerts = audit.latency_alerts(a.timings(spark, d), limit=100.0, every="1 hour")
    return _plain(alerts.withColumn("worst_p95_sec", F.round("worst_p95_sec", 6)))


def _drain(rows: DataFrame, label: str) -> DataFrame:
    """An append-mode stream run until its source is drained; what it has emitted."""
    spark = rows.sparkSession
    sink, settings, name = scratch_path(spark, label), spark.conf, "spark.sql.shuffle.partitions"
    before = settings.get(name)
    settings.set(name, str(spark.sparkContext.defaultParallelism))
    try:
        writer = rows.writeStream.outputMode("append").option("checkpointLocation", scratch_path(spark, f"state-{label}"))
        query = writer.trigger(availableNow=True).format("parquet").start(sink)
    finally:
        settings.set(name, before)
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(sink)


def q_stream_latency_alerts(spark: SparkSession, d: str) -> DataFrame:
    """The alert on a stream of the same timings, from sketches; stretches that the stream has closed."""
    timings = a.timings_of(_events(spark, d)).withWatermark("started_at", jobs.LATENESS)
    found = _drain(alerts.latency_alerts(timings, limit=100.0, every="1 hour"), "alerts")
    return _plain(found.withColumn("worst_p95_sec", F.round("worst_p95_sec", 3)))


def q_recent_history(spark: SparkSession, d: str) -> DataFrame:
    log = a.history(spark, d)
    return _plain(audit.recent_history(log, log.agg(F.max("start_time")).first()[0]))


def q_time_range(spark: SparkSession, d: str) -> DataFrame:
    return _plain(audit.time_range({"cdr_sgi_raw": a.cdr(spark, d), "cdr_mdt_smsng": a.mdt(spark, d)}))


def setup(spark: SparkSession, d: str) -> dict[str, Callable[[], object]]:
    """What builds the stored tables and sinks that these queries read; each query builds its own if it was not done before."""
    return {
        "q_lookup_hash": lambda: _keyed(spark, d, "call_quality_kudu"),
        "q_lookup_by_call": lambda: _keyed(spark, d, "call_quality_kudu_by_call"),
        "q_lookup_part": lambda: _dated(spark, d),
        "q_latest_windows": lambda: _drained(spark, d, dict.fromkeys(_CORES, windows.MINUTE)),
    }


# ---- contract -------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    return q_ltas_hourly(spark, SAMPLE_DIR)


def queries() -> dict[str, Query]:
    plain = [
        q_ltas_hourly, q_sgi_use_v1, q_sgi_use_v2, q_mdt_merge, q_grid_join, q_points_in_box, q_or_bridge, q_through_bridge, q_or_weights, q_rsrp_bad_rate,
        q_volte_drop, q_partition_count, q_region_total, q_mart_rsrp, q_mart_volte, q_lookup_hash, q_lookup_filtered, q_lookup_part,
        q_lookup_by_call, q_lookup_batch, q_upsert, q_published_upsert, q_upsert_delta, q_pit_join, q_win_ltas_versioned, q_fk_repair, q_domain_repair,
        q_clip_fill, q_time_keys, q_row_ids, q_dim_expand, q_load_summary, q_row_count_audit, q_eligible_counts,
        q_stream_batch_parity, q_latest_windows, q_window_checks, q_latency_summary, q_latency_alerts, q_stream_latency_alerts,
        q_recent_history, q_time_range, q_stored_days, q_stored_day, q_ingested_slices, q_loaded_drop, q_seed_csv,
        q_compacted, q_statistics, q_partitions, q_tail_restart, q_stream_late_rows, q_stream_late_corrected, q_parity_digests, q_mart_rsrp_stored, q_mart_volte_stored, q_mart_volte_incremental, q_mart_rsrp_incremental,
    ]
    found: dict[str, Query] = {f.__name__: f for f in plain}
    found["q_or_join_left"] = partial(_or_join, "left")
    found["q_or_join_inner"] = partial(_or_join, "inner")
    for job in _CORES:
        found[f"q_win_{job}"] = partial(_window, job, windows.MINUTE)
        found[f"q_win_{job}_all"] = partial(_window, job, None)
        found[f"q_stream_{job}"] = partial(_stream, job)
    for job in jobs.VERSIONED:
        if f"q_win_{job}_versioned" not in found:
            found[f"q_win_{job}_versioned"] = partial(_win_versioned, job)
        found[f"q_stream_{job}_versioned"] = partial(_stream_versioned, job)
    if corpus:
        found |= corpus.queries() | {"pipeline": corpus_pipeline.run}
    return found


def _pick_sql(record_id: str, choices: str) -> str:
    return f"(('0x' || substr(md5({record_id}), 1, 8))::UBIGINT % {choices})::BIGINT"


_EITHER = "bts.cell_id = cdr.cell_id OR bts.alt_cell_id = cdr.alt_cell_id"

# straight segments of the line views
_SEGS = """
segs_{t} AS (
  SELECT {cols}, gx AS x1, gy AS y1, CASE WHEN is_point THEN gx ELSE gx + dx END AS x2,
         CASE WHEN is_point THEN gy ELSE gy + dy END AS y2 FROM {t}
  UNION ALL
  SELECT {cols}, gx + dx, gy + dy, gx + dx, gy + 2 * dy FROM {t} WHERE NOT is_point)"""


def _dist(p: str, s: str) -> str:
    dx, dy = f"({s}.x2 - {s}.x1)", f"({s}.y2 - {s}.y1)"
    along = (
        f"(({p}.gnss_utmkx - {s}.x1) * {dx} + ({p}.gnss_utmky - {s}.y1) * {dy})"
        f" / nullif({dx} * {dx} + {dy} * {dy}, 0)"
    )
    t = f"coalesce(greatest(0.0, least(1.0, {along})), 0.0)"
    ex = f"({p}.gnss_utmkx - ({s}.x1 + {t} * {dx}))"
    ey = f"({p}.gnss_utmky - ({s}.y1 + {t} * {dy}))"
    return f"sqrt({ex} * {ex} + {ey} * {ey})"


def _near(where: str) -> str:
    """Views: numbered points, line segments, and (point, line) pairs within reach."""
    return f"""
    , points AS (SELECT row_number() OVER () AS rid, * FROM mdt WHERE {where}),
    {_SEGS.format(t="rpot", cols="rpot_seq, bts_market_nm, rpot_line_cnt")},
    near AS (SELECT p.rid, s.rpot_seq, any_value(s.rpot_line_cnt) AS cnt
             FROM points p JOIN segs_rpot s ON p.bts_market_nm = s.bts_market_nm
             GROUP BY p.rid, s.rpot_seq HAVING min({_dist("p", "s")}) < any_value(s.rpot_line_cnt) * 3)"""


# fixed values: which trigger each vendor reports
_TRIGGER = """((bts_market_nm = 'ERICSSON' AND trigr_ev = 'PERIODIC') OR (bts_market_nm = 'NOKIA' AND trigr_ev IS NULL)
    OR (bts_market_nm = 'SAMSUNG' AND trigr_ev = ''))"""

_START = "time_bucket(INTERVAL 5 MINUTE, event_time)"
_SPAN = f"{_START} AS window_start, window_start + INTERVAL 5 MINUTE AS window_end"
_MINUTE_45 = "substr(rqt_st_dt, 11, 2) = '45'"


def _window_body(job: str, where: str) -> str:
    """The job as one direct join and group."""
    if job == "ltas":
        return f"""SELECT {_SPAN}, bts_alt_key, region_cd, sum(val)::BIGINT AS total_val, count(*) AS record_cnt
            FROM cdr LEFT JOIN bts USING (cell_id) WHERE {where} GROUP BY ALL"""
    if job == "sgi_v1":
        return f"""SELECT {_SPAN}, bts_alt_key, region_cd, sum(CASE WHEN use_flag = 'Y' THEN val ELSE 0 END)::BIGINT AS total_val,
            count(*) AS record_cnt FROM cdr LEFT JOIN bts ON {_EITHER}
            WHERE {where} AND signal_type IN ('S1AP', 'SGI') GROUP BY ALL"""
    if job == "sgi_v2":
        return f"""SELECT {_SPAN}, coalesce(bts.bts_alt_key, cell_id) AS bts_alt_key, sum(val)::BIGINT AS total_val,
            count(*) AS record_cnt FROM cdr LEFT JOIN bts USING (cell_id) WHERE {where} GROUP BY ALL"""
    return f"""SELECT {_SPAN}, bts_alt_key, count(*) AS record_cnt
        FROM mdt_raw LEFT JOIN bts USING (bts_market_nm) WHERE {where} GROUP BY ALL"""


def _closed(job: str) -> str:
    """The windows that the job's stream has closed at the end of its input."""
    return f"""SELECT * FROM ({_window_body(job, _MINUTE_45)})
            WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"""


def _window_sql(job: str, where: str, closed_only: bool = False) -> str:
    views = "mdt_raw bts" if job == "mdt" else "cdr bts"
    return a.with_views(views, _closed(job) if closed_only else _window_body(job, where))


def _hits(condition: str) -> str:
    """Rows meeting a condition, NULL when there is none."""
    return f"sum(CASE WHEN {condition} THEN 1 END)::BIGINT"


def _rsrp_sql(keys: str, measures: str) -> str:
    return a.with_views(
        "mdt gpot bdri",
        f"""SELECT {keys}, {measures} FROM mdt
        JOIN gpot ON split_part(gnss_metric_id, '_', 1) = CAST(gpot25_x AS VARCHAR)
                 AND split_part(gnss_metric_id, '_', 2) = CAST(gpot25_y AS VARCHAR)
        JOIN bdri USING (bdri_cd) GROUP BY ALL""",
    )


_DROPPED = "sum(CASE WHEN volte_flag = 'Y' AND drop_flag = 'Y' THEN 1 ELSE 0 END)::BIGINT"
_RATE = f"{_DROPPED}::DOUBLE / nullif(sum(CASE WHEN volte_flag = 'Y' THEN 1 ELSE 0 END), 0)"


def _volte_sql(select: str) -> str:
    return a.with_views(
        "calls contracts products",
        f"""SELECT {select} FROM calls JOIN contracts USING (contract_id) JOIN products USING (product_id)
        WHERE volte_eligible = 'Y' GROUP BY ALL""",
    )


def oracle_sql() -> dict[str, str]:
    sql: dict[str, str] = {}
    sql["q_ltas_hourly"] = a.with_views(
        "cdr bts",
        """SELECT etl_date, substr(rqt_st_dt, 1, 10) AS base_hour, bts_alt_key, region_cd, sum(val)::BIGINT AS total_val,
        count(*) AS record_cnt FROM cdr LEFT JOIN bts USING (cell_id) GROUP BY ALL""",
    )
    sql["q_sgi_use_v1"] = a.with_views(
        "cdr bts",
        f"""SELECT etl_date, cdr.cell_id, sum(CASE WHEN use_flag = 'Y' THEN 1 ELSE 0 END)::BIGINT AS use_cnt
        FROM cdr LEFT JOIN bts ON {_EITHER} WHERE signal_type IN ('S1AP', 'SGI') GROUP BY ALL""",
    )
    sql["q_sgi_use_v2"] = a.with_views(
        "cdr bts",
        f"""SELECT etl_date, coalesce(bts_alt_key, cdr.cell_id) AS cell_id, count(*) AS use_cnt
        FROM cdr JOIN bts ON {_EITHER} GROUP BY ALL""",
    )
    for how in ("left", "inner"):
        sql[f"q_or_join_{how}"] = a.with_views(
            "cdr bts",
            f"""SELECT sgi_id, cdr.cell_id, cdr.alt_cell_id, bts_alt_key, region_cd
            FROM cdr {how.upper()} JOIN bts ON {_EITHER}""",
        )
    sql["q_through_bridge"] = sql["q_or_join_left"]
    sql["q_or_bridge"] = a.with_views(
        "cdr bts",
        f"""SELECT DISTINCT cdr.cell_id, cdr.alt_cell_id, bts_alt_key, region_cd
        FROM cdr LEFT JOIN bts ON {_EITHER}""",
    )
    sql["q_or_weights"] = a.with_views(
        "bts",
        """SELECT cell_id AS d_k1, NULL AS d_k2, region_cd, count(*) AS weight FROM bts GROUP BY ALL
        UNION ALL SELECT NULL, alt_cell_id, region_cd, count(*) FROM bts GROUP BY ALL
        UNION ALL SELECT cell_id, alt_cell_id, region_cd, -count(*) FROM bts GROUP BY ALL""",
    )
    sql["q_grid_join"] = a.with_views(
        "mdt rpot",
        f"""{_near("true")}
        SELECT p.mdt_id, p.gnss_utmkx, p.gnss_utmky, p.bts_market_nm, n.rpot_seq::INTEGER AS rpot_seq,
               CAST(n.cnt * 3 AS INTEGER) AS reach FROM near n JOIN points p ON n.rid = p.rid""",
    )
    sql["q_points_in_box"] = a.with_views(
        "mdt",
        f"""SELECT mdt_id, gnss_utmkx, gnss_utmky, bts_market_nm, rsrp FROM mdt
        WHERE gnss_utmkx BETWEEN {BOX[0]} AND {BOX[2]} AND gnss_utmky BETWEEN {BOX[1]} AND {BOX[3]}""",
    )
    sql["q_mdt_merge"] = a.with_views(
        "mdt bts rpot",
        f"""{_near(_TRIGGER)}, {_SEGS.format(t="bts", cols="cell_id, bts_alt_key, bts_market_nm")},
        spread AS (SELECT n.rid, n.rpot_seq, s.cell_id, any_value(s.bts_alt_key) AS bts_alt_key,
                          round(min({_dist("p", "s")}), 6) AS distance_m
                   FROM near n JOIN points p ON n.rid = p.rid JOIN segs_bts s ON p.bts_market_nm = s.bts_market_nm
                   GROUP BY n.rid, n.rpot_seq, s.cell_id)
        SELECT p.mdt_id, p.gnss_utmkx, p.gnss_utmky, x.bts_alt_key, x.distance_m, p.base_date
        FROM spread x JOIN points p ON x.rid = p.rid""",
    )
    # fixed values: bands and limits of signal strength
    band = "dlearfcn_cd IN ('1550', '1650', '1694', '1700')"
    measures = {
        "rsrp_18_o75": f"{band} AND rsrp > -75",
        "rsrp_18_u110": f"{band} AND rsrp <= -110",
        "rsrp_18_tot": band,
        "rsrp_o75": "rsrp > -75",
        "rsrp_u110": "rsrp <= -110",
    }
    sql["q_rsrp_bad_rate"] = _rsrp_sql(
        ", ".join(bi.AREA), ", ".join(f"{_hits(c)} AS {n}" for n, c in measures.items()) + ", count(*) AS rsrp_tot"
    )
    sql["q_mart_rsrp"] = _rsrp_sql(
        "'R1' AS run_id, base_date, sido_name, gungu_name",
        f"count(*) AS rsrp_tot, {_hits(measures['rsrp_u110'])} AS rsrp_u110",
    )
    sql["q_volte_drop"] = _volte_sql(
        f"base_date, count(*) AS total_calls, {_DROPPED} AS dropped_volte, {_RATE} AS volte_drop_rate"
    )
    sql["q_mart_volte"] = _volte_sql(
        f"'R1' AS run_id, time_bucket(INTERVAL 5 MINUTE, started) AS window_start, {_RATE} AS drop_rate,"
        f" count(*) AS total_calls, {_DROPPED} AS dropped_calls"
    )
    sql["q_mart_rsrp_incremental"], sql["q_mart_volte_incremental"] = sql["q_mart_rsrp"], sql["q_mart_volte"]
    sql["q_partition_count"] = "SELECT 'Q3' AS query_id, count(*) AS row_cnt FROM events"
    sql["q_region_total"] = a.with_views(
        "cdr bts",
        """SELECT 'Q4' AS query_id, region_cd, sum(val)::BIGINT AS total_val
        FROM cdr JOIN bts USING (cell_id) GROUP BY ALL""",
    )
    columns = ", ".join(lookup.QUALITY)
    sql["q_lookup_hash"] = a.with_views(
        "quality", f"SELECT {columns} FROM quality WHERE lookup_key = 'LOOKUP_KEY_00001'"
    )
    sql["q_lookup_filtered"] = a.with_views("quality", f"SELECT {columns} FROM quality WHERE call_id = 'CALL_00099'")
    sql["q_lookup_part"] = a.with_views(
        "quality",
        f"""SELECT {columns} FROM quality WHERE lookup_key = 'LOOKUP_KEY_00001' AND base_date IN
        (SELECT strftime(o_orderdate, '%Y%m%d') FROM orders WHERE o_orderkey = 1)""",
    )
    sql["q_lookup_by_call"] = a.with_views(
        "quality",
        """SELECT call_id, base_date, lookup_key, rsrp, drop_flag FROM quality
        WHERE call_id = 'CALL_00099' AND base_date BETWEEN '19960101' AND '19991231'
        QUALIFY row_number() OVER (PARTITION BY call_id, base_date
                                   ORDER BY lookup_key DESC, rsrp DESC, drop_flag DESC) = 1""",
    )
    sql["q_lookup_batch"] = a.with_views(
        "quality",
        f"""SELECT concat('LOOKUP_KEY_', CASE WHEN event_id * 2 < 100000 THEN lpad(CAST(event_id * 2 AS VARCHAR), 5, '0')
               ELSE CAST(event_id * 2 AS VARCHAR) END) AS lookup_key,
            {", ".join(f"q.{c}" for c in lookup.QUALITY[1:])}, q.lookup_key IS NOT NULL AS found
        FROM events e LEFT JOIN quality q ON q.lookup_key = concat('LOOKUP_KEY_',
            CASE WHEN event_id * 2 < 100000 THEN lpad(CAST(event_id * 2 AS VARCHAR), 5, '0')
                 ELSE CAST(event_id * 2 AS VARCHAR) END)""",
    )
    newest = ", ".join(f"{c} DESC" for c in UPSERT_ORDER)
    sql["q_upsert"] = a.with_views(
        "quality quality_changes",
        f"""SELECT {columns} FROM (SELECT {columns} FROM quality UNION ALL SELECT {columns} FROM quality_changes)
        QUALIFY row_number() OVER (PARTITION BY lookup_key ORDER BY {newest}) = 1""",
    )
    sql["q_upsert_delta"] = sql["q_published_upsert"] = sql["q_upsert"]
    for job in _CORES:
        sql[f"q_win_{job}"] = _window_sql(job, _MINUTE_45)
        sql[f"q_win_{job}_all"] = _window_sql(job, "true")
        sql[f"q_stream_{job}"] = _window_sql(job, _MINUTE_45, closed_only=True)
    as_of = "FROM cdr ASOF LEFT JOIN versions v ON cdr.cell_id = v.cell_id AND cdr.event_time >= v.valid_from"
    sql["q_pit_join"] = a.with_views(
        "cdr versions", f"SELECT sgi_id, cdr.cell_id, event_time, bts_alt_key, region_cd {as_of}"
    )
    sql["q_win_ltas_versioned"] = a.with_views(
        "cdr versions",
        f"""SELECT {_SPAN}, bts_alt_key, region_cd, sum(val)::BIGINT AS total_val, count(*) AS record_cnt
        {as_of} GROUP BY ALL""",
    )
    dated = f""", dated AS (SELECT *, {a._VENDOR.format(k="CAST(cell_id AS BIGINT)")} AS bts_market_nm,
                                   CAST(CAST(cell_id AS BIGINT) // 4 AS VARCHAR) AS alt_cell_id,
                                   lead(valid_from) OVER (PARTITION BY cell_id ORDER BY valid_from) AS valid_to FROM versions)"""
    # a version reached by both keys counts once
    either = """(SELECT sgi_id, v.cell_id, v.valid_from FROM cdr r JOIN dated v ON r.cell_id = v.cell_id AND {at}
            UNION SELECT sgi_id, v.cell_id, v.valid_from FROM cdr r JOIN dated v ON r.alt_cell_id = v.alt_cell_id AND {at})"""
    either = either.format(at="r.event_time >= v.valid_from AND (v.valid_to IS NULL OR r.event_time < v.valid_to)")
    by_moment = {
        "sgi_v1": (
            "cdr",
            f"""v.bts_alt_key, v.region_cd, sum(CASE WHEN use_flag = 'Y' THEN val ELSE 0 END)::BIGINT AS total_val, count(*) AS record_cnt
            FROM cdr LEFT JOIN {either} m USING (sgi_id) LEFT JOIN dated v ON m.cell_id = v.cell_id AND m.valid_from = v.valid_from""",
        ),
        "ltas": ("cdr", f"bts_alt_key, region_cd, sum(val)::BIGINT AS total_val, count(*) AS record_cnt {as_of}"),
        "sgi_v2": (
            "cdr",
            f"coalesce(bts_alt_key, cdr.cell_id) AS bts_alt_key, sum(val)::BIGINT AS total_val, count(*) AS record_cnt {as_of}",
        ),
        "mdt": (
            "mdt_raw",
            """bts_alt_key, count(*) AS record_cnt FROM mdt_raw r LEFT JOIN dated v ON r.bts_market_nm = v.bts_market_nm
            AND r.event_time >= v.valid_from AND (v.valid_to IS NULL OR r.event_time < v.valid_to)""",
        ),
    }
    for job, (view, body) in by_moment.items():
        signals = " AND signal_type IN ('S1AP', 'SGI')" if job == "sgi_v1" else ""
        whole = f"SELECT {_SPAN}, {body} WHERE {_MINUTE_45}{signals} GROUP BY ALL"
        closed = f"SELECT * FROM ({whole}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"
        sql.setdefault(f"q_win_{job}_versioned", a.with_views(f"{view} versions", f"{dated} {whole}"))
        sql[f"q_stream_{job}_versioned"] = a.with_views(f"{view} versions", f"{dated} {closed}")
    last_day = "(SELECT strftime(max(ts), '%Y%m%d') FROM events)"
    sql["q_stored_days"] = a.with_views(
        "cdr",
        f"""SELECT etl_date, count(*) AS row_cnt, sum(CASE WHEN etl_date = {last_day} THEN 2 * val ELSE val END)::BIGINT AS total_val
        FROM cdr GROUP BY etl_date""",
    )
    sql["q_stored_day"] = a.with_views("cdr", f"SELECT sgi_id, cell_id, val, etl_date FROM cdr WHERE etl_date = {last_day}")
    sql["q_ingested_slices"] = a.with_views(
        "cdr",
        "SELECT sgi_id, cell_id, val, strftime(event_time, '%Y-%m-%d') AS event_date FROM cdr",
    )
    sql["q_loaded_drop"] = """SELECT 'cdr_sgi_raw' AS tbl, 2 * count(*) + count(*) FILTER (WHERE event_id = 1) AS row_cnt,
        max(ts) AS newest FROM events
        UNION ALL SELECT 'cdr_mdt_smsng_raw', 2 * count(*) + count(*) FILTER (WHERE event_id = 1), max(ts) FROM events
        UNION ALL SELECT 'bts_master', count(*), NULL FROM supplier"""
    sql["q_seed_csv"] = a.with_views(
        "bts",
        """SELECT cell_id, CASE WHEN s.s_suppkey % 20 <> 0 THEN alt_cell_id END AS alt_cell_id, bts_alt_key,
        CASE WHEN s.s_suppkey % 20 > 9 THEN region_cd ELSE '' END AS region_cd,
        CAST(s.s_suppkey % 20 + 1 AS INTEGER) AS rpot_line_cnt
        FROM bts JOIN supplier s ON bts.cell_id = CAST(s.s_suppkey AS VARCHAR)""",
    )
    sql["q_compacted"] = a.with_views(
        "cdr", "SELECT etl_date, cell_id, count(*) AS row_cnt, sum(val)::BIGINT AS total_val FROM cdr GROUP BY ALL"
    )
    keys = {"cdr_sgi_raw": ("cdr", STATISTICS["cdr_sgi_raw"]), "bts_master": ("bts", STATISTICS["bts_master"])}
    sql["q_statistics"] = a.with_views(
        "cdr bts",
        " UNION ALL ".join(
            f"SELECT '{table}' AS tbl, count(*) AS row_cnt, {f"'{c}'" if c else "NULL"} AS column_name,"
            f" {f'count(*) - count({c})' if c else 'NULL::BIGINT'} AS null_cnt FROM {view}"
            for table, (view, columns) in keys.items()
            for c in columns or [None]
        ),
    )
    sql["q_partitions"] = "SELECT DISTINCT 'event_date=' || strftime(ts, '%Y-%m-%d') AS partition FROM events"
    sql["q_stream_late_rows"] = f"""WITH arrivals AS (SELECT event_id % 4 AS batch, ts AS event_time FROM events),
        marks AS (SELECT k AS batch, (SELECT max(event_time) FROM arrivals WHERE arrivals.batch < k) AS mark FROM range(4) AS t(k))
        SELECT batch::BIGINT AS batch, {_START} AS window_start, count(*) AS late_cnt FROM arrivals JOIN marks USING (batch)
        WHERE {_START} + INTERVAL 5 MINUTE <= mark - INTERVAL 10 SECOND GROUP BY ALL"""
    sql["q_stream_late_corrected"] = sql["q_stream_ltas"]
    sql["q_tail_restart"] = sql["q_stream_ltas"]
    both_runs = "FROM ({}) CROSS JOIN (VALUES ('R1'), ('R2')) runs(run_id)"
    rsrp = _rsrp_sql(
        "base_date, sido_name, gungu_name",
        f"count(*) AS rsrp_tot, {_hits(measures['rsrp_u110'])} AS rsrp_u110",
    )
    sql["q_mart_rsrp_stored"] = f"SELECT * {both_runs.format(rsrp)}"
    starts = "CASE WHEN product_id <> '1' THEN time_bucket(INTERVAL 5 MINUTE, started) END"
    volte = _volte_sql(f"{starts} AS window_start, {_RATE} AS drop_rate, count(*) AS total_calls, {_DROPPED} AS dropped_calls")
    sql["q_mart_volte_stored"] = f"SELECT * {both_runs.format(volte)}"
    sql["q_fk_repair"] = a.with_views(
        "cdr bts",
        f""", stations AS (SELECT cell_id, alt_cell_id, row_number() OVER (ORDER BY cell_id) - 1 AS n FROM bts),
        total AS (SELECT count(*) AS c FROM stations)
        SELECT s.sgi_id, coalesce(k.cell_id, r.cell_id) AS cell_id,
               coalesce(k.alt_cell_id, r.alt_cell_id, s.alt_cell_id) AS alt_cell_id
        FROM cdr s CROSS JOIN total LEFT JOIN stations k ON s.cell_id = k.cell_id
        LEFT JOIN stations r ON k.cell_id IS NULL AND r.n = {_pick_sql("s.sgi_id", "total.c")}""",
    )

    def domain(column: str, first: str, second: str) -> str:
        return (
            f"CASE WHEN {column} IN ('{first}', '{second}') THEN {column}"
            f" WHEN {_pick_sql('sgi_id', '2')} = 0 THEN '{first}' ELSE '{second}' END AS {column}"
        )

    sql["q_domain_repair"] = a.with_views(
        "cdr", f"SELECT sgi_id, {domain('signal_type', 'S1AP', 'SGI')}, {domain('use_flag', 'Y', 'N')} FROM cdr"
    )
    sql["q_clip_fill"] = """SELECT CAST(event_id AS VARCHAR) AS mdt_id,
        least(greatest(coalesce(value * 1000, 961000), 900000), 1100000)::DOUBLE
            AS gnss_utmkx,
        least(greatest(coalesce(value * 2000, 1946000), 1900000), 2100000)::DOUBLE
            AS gnss_utmky FROM events"""
    sql["q_time_keys"] = a.with_views("cdr", "SELECT sgi_id, etl_date, rqt_st_dt FROM cdr")
    sql["q_row_ids"] = a.with_views(
        "cdr",
        """SELECT sgi_id AS source_id,
        'SGI' || lpad(CAST(row_number() OVER (ORDER BY event_time) - 1 AS VARCHAR), 12, '0') AS sgi_id FROM cdr""",
    )
    # fixed values: regions and vendors in rotation
    region = (
        "(['SEOUL', 'BUSAN', 'DAEGU', 'INCHEON', 'GWANGJU', 'DAEJEON', 'ULSAN', 'SUWON', 'JEJU', 'CHANGWON'])"
        "[c_custkey % 10 + 1]"
    )
    sql["q_dim_expand"] = f"""SELECT printf('CELL_%06d', c_custkey) AS cell_id,
        printf('CELL_%06d_ALT', c_custkey) AS alt_cell_id,
        'BTS_' || {region} || printf('_%04d', c_custkey) AS bts_alt_key,
        (['SAMSUNG', 'ERICSSON', 'NOKIA'])[c_custkey % 3 + 1] AS bts_market_nm, {region} AS region_cd FROM customer"""
    eligible = f"count(*) FILTER (WHERE {_MINUTE_45})"
    sql["q_load_summary"] = a.with_views(
        "cdr mdt_raw bts",
        f"""SELECT 'bts_master' AS tbl, COUNT(*) AS row_cnt, CAST(NULL AS BIGINT) AS filter_pass_cnt FROM bts
        UNION ALL SELECT 'cdr_sgi_raw', COUNT(*), {eligible} FROM cdr
        UNION ALL SELECT 'cdr_mdt_smsng_raw', COUNT(*), {eligible} FROM mdt_raw""",
    )
    sql["q_row_count_audit"] = """
        WITH counts AS (SELECT 'cdr_sgi' AS tbl, (SELECT count(*) FROM events) AS cnt,
                               (SELECT count(*) FROM events) AS expected
          UNION ALL SELECT 'bts_master', (SELECT count(*) FROM supplier), (SELECT count(*) FROM customer)
          UNION ALL SELECT 'cdr_mdt_smsng', (SELECT count(*) FROM lineitem), NULL)
        SELECT tbl, cnt, expected, CASE WHEN expected IS NULL THEN 'pending' WHEN cnt = expected THEN 'ok'
               ELSE 'mismatch' END AS status FROM counts"""
    sql["q_eligible_counts"] = a.with_views(
        "cdr mdt_raw",
        f"""SELECT 'cdr_sgi_raw' AS tbl, {eligible} AS cnt FROM cdr
        UNION ALL SELECT 'cdr_mdt_smsng_raw', {eligible} FROM mdt_raw""",
    )
    both_sides = " UNION ALL ".join(
        f"""SELECT '{job}' AS job, sum(record_cnt)::BIGINT AS batch_count,
        coalesce(sum(record_cnt) FILTER (WHERE closed), 0)::BIGINT AS stream_count,
        -coalesce(sum(record_cnt) FILTER (WHERE NOT closed), 0)::BIGINT AS diff,
        count(*) FILTER (WHERE NOT closed) AS differing_keys
        FROM (SELECT *, window_end <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND AS closed
              FROM ({_window_body(job, "true" if minute is None else _MINUTE_45)}))"""
        for job, minute in _PARITY_MINUTE.items()
    )
    open_keys = " UNION ALL ".join(
        f"""SELECT '{job}' AS job, window_start, bts_alt_key, record_cnt AS batch_record_cnt, NULL::BIGINT AS stream_record_cnt, 'batch' AS side
        FROM ({_window_body(job, "true" if job == "ltas" else _MINUTE_45)}) WHERE window_end > (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"""
        for job in ("ltas", "mdt")
    )
    sql["q_parity_digests"] = a.with_views("cdr mdt_raw bts", open_keys)
    sql["q_stream_batch_parity"] = a.with_views("cdr mdt_raw bts", both_sides)
    lacking = {"sgi_v2": {"region_cd"}, "mdt": {"region_cd", "total_val"}}
    newest_rows = " UNION ALL ".join(
        f"""(SELECT '{jobs.JOBS[job][2]}' AS tbl, window_start, window_end, bts_alt_key,
        {"NULL" if "region_cd" in lacking.get(job, ()) else "region_cd"} AS region_cd,
        {"NULL" if "total_val" in lacking.get(job, ()) else "total_val"}::BIGINT AS total_val, record_cnt
        FROM ({_closed(job)})
        ORDER BY window_start DESC, bts_alt_key NULLS LAST, region_cd NULLS LAST LIMIT 10)"""
        for job in _CORES
    )
    sql["q_latest_windows"] = a.with_views("cdr mdt_raw bts", newest_rows)
    checks = " UNION ALL ".join(
        f"""SELECT '{jobs.JOBS[job][2]}' AS tbl, 'bad_window' AS kind,
        COUNT(*) FILTER (window_end - window_start <> INTERVAL 5 MINUTE
                         OR epoch(window_start) % 300 <> 0) AS violations FROM ({_closed(job)})
        UNION ALL SELECT '{jobs.JOBS[job][2]}', 'bad_filter', COUNT(*) FROM ({_closed(job)})
        WHERE window_start NOT IN (SELECT {_START} FROM {"mdt_raw" if job == "mdt" else "cdr"} WHERE {_MINUTE_45})"""
        for job in _CORES
    )
    sql["q_window_checks"] = a.with_views("cdr mdt_raw bts", checks)
    sql["q_latency_summary"] = a.with_views(
        "timings",
        """SELECT engine, COUNT(*) AS n, max(elapsed_sec) AS max_sec, round(avg(elapsed_sec), 6) AS avg_sec,
        round(quantile_cont(elapsed_sec, 0.95), 6) AS p95_sec, round(quantile_cont(elapsed_sec, 0.99), 6) AS p99_sec
        FROM timings WHERE elapsed_sec >= 0 GROUP BY engine""",
    )
    sql["q_latency_alerts"] = a.with_views(
        "timings",
        """, slots AS (SELECT engine, date_trunc('hour', started_at) AS slot, quantile_cont(elapsed_sec, 0.95) AS p95
                       FROM timings WHERE elapsed_sec >= 0 GROUP BY ALL HAVING quantile_cont(elapsed_sec, 0.95) > 100),
        runs AS (SELECT *, epoch(slot) / 3600 - row_number() OVER (PARTITION BY engine ORDER BY slot) AS run FROM slots)
        SELECT engine, min(slot) AS first_slot, max(slot) AS last_slot, COUNT(*) AS slots,
               round(max(p95), 6) AS worst_p95_sec FROM runs GROUP BY engine, run HAVING COUNT(*) >= 5""",
    )
    # counts per bucket of one percent of relative error; the quantile of each bucket's middle
    factor = "(1.01 / 0.99)"
    row_of = {"lo": "floor(0.95 * (total - 1))", "hi": "ceil(0.95 * (total - 1))"}
    middles = {s: f"2 / ({factor} + 1) * pow({factor}, min(bucket) FILTER (WHERE upto > {r}))" for s, r in row_of.items()}
    sql["q_stream_latency_alerts"] = a.with_views(
        "timings",
        f""", counted AS (SELECT engine, date_trunc('hour', started_at) AS slot,
                   ceil(ln(greatest(elapsed_sec, 1e-9)) / ln({factor})) AS bucket, count(*) AS n
                   FROM timings WHERE elapsed_sec >= 0 GROUP BY ALL),
        running AS (SELECT *, sum(n) OVER (PARTITION BY engine, slot ORDER BY bucket) AS upto,
                           sum(n) OVER (PARTITION BY engine, slot) AS total FROM counted),
        slots AS (SELECT engine, slot, any_value(total) AS total, {middles["lo"]} AS lo, {middles["hi"]} AS hi FROM running GROUP BY ALL),
        high AS (SELECT engine, slot, lo + (hi - lo) * (0.95 * (total - 1) - floor(0.95 * (total - 1))) AS p95 FROM slots WHERE p95 > 100),
        runs AS (SELECT *, epoch(slot) / 3600 - row_number() OVER (PARTITION BY engine ORDER BY slot) AS run FROM high)
        SELECT engine, min(slot) AS first_slot, max(slot) AS last_slot, COUNT(*) AS slots, round(max(p95), 3) AS worst_p95_sec
        FROM runs GROUP BY engine, run
        HAVING COUNT(*) >= 5 AND max(slot) + INTERVAL 150 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND""",
    )
    sql["q_recent_history"] = """SELECT event_id AS query_id, event_type AS stmt, ts AS start_time,
        floor(value * 1000)::BIGINT / 1000 AS duration_sec FROM events
        WHERE ts > (SELECT max(ts) FROM events) - INTERVAL 24 HOUR ORDER BY ts DESC, event_id LIMIT 50"""
    sql["q_time_range"] = """SELECT 'cdr_sgi_raw' AS tbl, min(ts) AS min_time, max(ts) AS max_time FROM events
        UNION ALL SELECT 'cdr_mdt_smsng', min(l_shipdate), max(l_shipdate) FROM lineitem"""
    if corpus:
        sql |= corpus.oracle_sql()
        if corpus_pipeline.ORACLE_SQL:
            sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return sql
