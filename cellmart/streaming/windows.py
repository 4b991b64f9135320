"""Five-minute window cores: one pure function per job, for batch and stream alike.

Every core sums per window and raw key first, then joins the station dimension
to those sums and sums again per station. On a stream that is a chain of two
append-mode aggregations; a hot cell or a vendor shared by thousands of stations
reaches the join as one row per window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.functions.predicates import SIGNALS, minute_is
from cellmart.operators.or_join import KEYS, or_join_sums, or_weights
from cellmart.operators.pit_join import pit_join
from cellmart.operators.pit_sums import NO_LEG, covered, pit_sums
from cellmart.operators.sizing import dim_join

WINDOW = "5 minutes"
MINUTE = "45"


def windowed(rows: DataFrame, minute: str | None, also: Column | None = None) -> DataFrame:
    """Add ``window`` and keep the rows of the wanted minute.

    All row conditions sit inside one expression on the event time. Otherwise the
    optimizer moves them below the watermark, rejected rows stop advancing it, and
    windows stay open.
    """
    keep = None if minute is None else minute_is("rqt_st_dt", minute)
    if also is not None:
        keep = also if keep is None else keep & also
    if keep is not None:
        rows = rows.where(F.when(F.col("event_time").isNotNull(), keep))
    return rows.withColumn("window", F.window("event_time", WINDOW))


def flat(sums: DataFrame, *columns: str) -> DataFrame:
    return sums.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *columns
    )


def ltas(cdr: DataFrame, bts: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """Value and records per window, station and region."""
    per_cell = (
        windowed(cdr, minute)
        .groupBy("window", "cell_id")
        .agg(F.sum("val").alias("total_val"), F.count(F.lit(1)).alias("record_cnt"))
    )
    sums = (
        per_cell.join(bts.select("cell_id", "bts_alt_key", "region_cd"), "cell_id", "left")
        .groupBy("window", "bts_alt_key", "region_cd")
        .agg(F.sum("total_val").alias("total_val"), F.sum("record_cnt").alias("record_cnt"))
    )
    return flat(sums, "bts_alt_key", "region_cd", "total_val", "record_cnt")


def ltas_versioned(cdr: DataFrame, versions: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """:func:`ltas` with the station version in force at each record; joined per record, since one window may span
    two versions. ``versions`` holds station columns, ``valid_from`` and ``valid_to``."""
    stations = versions.select("cell_id", "bts_alt_key", "region_cd", "valid_from", "valid_to")
    joined = windowed(pit_join(cdr, stations, "cell_id"), minute)
    sums = joined.groupBy("window", "bts_alt_key", "region_cd").agg(
        F.sum("val").alias("total_val"), F.count(F.lit(1)).alias("record_cnt")
    )
    return flat(sums, "bts_alt_key", "region_cd", "total_val", "record_cnt")


def sgi_v1(cdr: DataFrame, bts: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """Used value and records of the signalling types, stations matched on either cell key."""
    rows = windowed(cdr, minute, F.col("signal_type").isin(*SIGNALS)).select(
        "window",
        "cell_id",
        "alt_cell_id",
        F.when(F.col("use_flag") == "Y", F.col("val")).otherwise(0).alias("total_val"),
        F.lit(1).cast("long").alias("record_cnt"),
    )
    station = ["bts_alt_key", "region_cd"]
    sums = or_join_sums(rows, or_weights(bts, station), ["window"], ["total_val", "record_cnt"], station, "left")
    return flat(sums, "bts_alt_key", "region_cd", "total_val", "record_cnt")


def _nothing(dated: DataFrame) -> DataFrame:
    """The row that events without a version in force meet: no key, no station, always in force."""
    known = {"leg": F.lit(NO_LEG), "weight": F.lit(1), "valid_from": F.lit("0001-01-01").cast("timestamp")}
    return dated.sparkSession.range(1).select(
        *[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in dated.schema.fields]
    )


def sgi_v1_versioned(cdr: DataFrame, versions: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """:func:`sgi_v1` with the stations in force at each record, matched on either cell key.

    The matches of a record are the versions in force of its first key, plus those of its second, minus those of both: a version
    reached by both counts once. Each way has its own key; sums per stretch between changes meet the versions
    (:func:`pit_sums`). Records that reach no version in force come under NULL.
    """
    first, second = KEYS
    some = cdr.select(first, second, "rqt_st_dt", "signal_type", "use_flag", "val", "event_time")
    rows = windowed(covered(some, versions, KEYS), minute, F.col("signal_type").isin(*SIGNALS))
    none, in1, in2 = F.lit(None).cast("string"), F.col(f"_in_{first}"), F.col(f"_in_{second}")

    def leg(number: int, k1: Column, k2: Column) -> Column:
        return F.struct(F.lit(number).alias("leg"), k1.alias("k1"), k2.alias("k2"))

    ways = [
        (in1, leg(1, F.col(first), none)),
        (in2, leg(2, none, F.col(second))),
        (in1 & in2, leg(3, F.col(first), F.col(second))),
        (~in1 & ~in2, leg(NO_LEG, none, none)),
    ]
    legs = F.filter(F.array(*[F.when(held, way) for held, way in ways]), lambda x: x.isNotNull())
    rows = rows.select(
        "window",
        "event_time",
        F.when(F.col("use_flag") == "Y", F.col("val")).otherwise(0).alias("total_val"),
        F.lit(1).cast("long").alias("record_cnt"),
        F.explode(legs).alias("_at"),
    ).select("window", "event_time", "total_val", "record_cnt", "_at.*")
    station = ["bts_alt_key", "region_cd"]
    sides = F.explode(F.array(leg(1, F.col(first), none), leg(2, none, F.col(second)), leg(3, F.col(first), F.col(second)))).alias("_at")
    dated = versions.select(*station, "valid_from", "valid_to", sides).select("_at.*", *station, "valid_from", "valid_to")
    whole_key = F.when(F.col("leg") == 3, F.col("k1").isNotNull() & F.col("k2").isNotNull()).otherwise(F.coalesce("k1", "k2").isNotNull())
    dated = dated.where(whole_key).withColumn("weight", F.when(F.col("leg") == 3, -1).otherwise(1))
    dated = dated.unionByName(_nothing(dated))
    sums = pit_sums(rows, dated, ["leg", "k1", "k2"], ["total_val", "record_cnt"], station, "record_cnt", every=WINDOW)
    return flat(sums, "bts_alt_key", "region_cd", "total_val", "record_cnt")


def sgi_v2(cdr: DataFrame, bts: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """Value and records per window and station, or the record's cell when unknown."""
    per_cell = (
        windowed(cdr, minute)
        .groupBy("window", "cell_id")
        .agg(F.sum("val").alias("total_val"), F.count(F.lit(1)).alias("record_cnt"))
    )
    sums = (
        per_cell.join(bts.select("cell_id", F.col("bts_alt_key").alias("_station")), "cell_id", "left")
        .groupBy("window", F.coalesce("_station", "cell_id").alias("bts_alt_key"))
        .agg(F.sum("total_val").alias("total_val"), F.sum("record_cnt").alias("record_cnt"))
    )
    return flat(sums, "bts_alt_key", "total_val", "record_cnt")


def sgi_v2_versioned(cdr: DataFrame, versions: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """:func:`sgi_v2` with the station version in force at each record."""
    stations = versions.select("cell_id", F.col("bts_alt_key").alias("_station"), "valid_from", "valid_to")
    joined = windowed(pit_join(cdr, stations, "cell_id"), minute)
    sums = joined.groupBy("window", F.coalesce("_station", "cell_id").alias("bts_alt_key")).agg(
        F.sum("val").alias("total_val"), F.count(F.lit(1)).alias("record_cnt")
    )
    return flat(sums, "bts_alt_key", "total_val", "record_cnt")


def mdt_versioned(measurements: DataFrame, versions: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """:func:`mdt` with the stations a vendor had at each measurement.

    Measurements are counted per stretch between a vendor's changes, so rows follow changes and stations, not measurements
    times stations; see :func:`pit_sums`.
    """
    vendor = "bts_market_nm"
    rows = windowed(covered(measurements.select(vendor, "rqt_st_dt", "event_time"), versions, [vendor]), minute)
    known = F.col(f"_in_{vendor}")
    rows = rows.select(
        "window",
        "event_time",
        F.when(known, 1).otherwise(NO_LEG).alias("leg"),
        F.when(known, F.col(vendor)).alias("k1"),
        F.lit(1).cast("long").alias("record_cnt"),
    )
    stations = versions.where(F.col(vendor).isNotNull()).select(F.lit(1).alias("leg"), F.col(vendor).alias("k1"), "bts_alt_key", "valid_from", "valid_to", F.lit(1).alias("weight"))
    dated = stations.unionByName(_nothing(stations))
    sums = pit_sums(rows, dated, ["leg", "k1"], ["record_cnt"], ["bts_alt_key"], "record_cnt", every=WINDOW)
    return flat(sums, "bts_alt_key", "record_cnt")


def mdt(measurements: DataFrame, bts: DataFrame, minute: str | None = MINUTE) -> DataFrame:
    """Measurements per window for every station of the reporting vendor; those of vendors without stations come under NULL.

    The vendors' counts of a window are put together first, so a station that several vendors have is summed from its own row, by
    the first of its vendors that reported, and the rows of all stations are never grouped: state and memory follow windows and vendors.
    """
    vendor = "bts_market_nm"
    per_vendor = windowed(measurements, minute).groupBy("window", vendor).agg(F.count(F.lit(1)).alias("record_cnt"))
    owned = bts.where(F.col(vendor).isNotNull())
    marked = dim_join(per_vendor, owned.select(vendor).distinct().withColumn("_known", F.lit(True)), [vendor], "left")
    if not measurements.isStreaming:
        # every window meets thousands of stations: placed by window, those rows stay where they are
        marked = marked.repartition(int(measurements.sparkSession.conf.get("spark.sql.shuffle.partitions")), "window")
    count = F.struct(F.when(F.col("_known"), F.col(vendor)).alias("vendor"), "record_cnt")
    per_window = marked.groupBy("window").agg(F.collect_list(count).alias("_counts"))

    def counted(name: Column) -> Column:
        own = F.filter("_counts", lambda c: c["vendor"].eqNullSafe(name))
        return F.aggregate(own, F.lit(0).cast("long"), lambda total, c: total + c["record_cnt"])

    names = F.explode(F.array_distinct(F.transform("_counts", lambda c: c["vendor"]))).alias("_vendor")
    placed = per_window.select("window", "_counts", names).withColumn("_own", counted(F.col("_vendor")))
    none = [F.lit(None).cast(bts.schema[c].dataType).alias(c) for c in (vendor, "bts_alt_key")]
    unknown = bts.sparkSession.range(1).select(*none, F.lit(1).cast("long").alias("copies"))
    copies = owned.groupBy(vendor, "bts_alt_key").agg(F.count(F.lit(1)).alias("copies")).unionByName(unknown)
    mixes = copies.groupBy("bts_alt_key").agg(F.sort_array(F.collect_list(F.struct(F.col(vendor).alias("vendor"), "copies"))).alias("_mix"))
    stations = mixes.withColumn("_vendor", F.explode(F.transform("_mix", lambda m: m["vendor"])))
    joined = dim_join(placed, stations, ["_vendor"], "inner", null_safe=True)
    single = F.size("_mix") == 1
    present = F.filter("_mix", lambda m: F.exists("_counts", lambda c: c["vendor"].eqNullSafe(m["vendor"])))
    total = F.aggregate("_mix", F.lit(0).cast("long"), lambda t, m: t + m["copies"] * counted(m["vendor"]))
    once = joined.where(F.when(single, F.lit(True)).otherwise(F.get(present, F.lit(0))["vendor"].eqNullSafe(F.col("_vendor"))))
    sums = once.select("window", "bts_alt_key", F.when(single, F.col("_own") * F.get("_mix", F.lit(0))["copies"]).otherwise(total).alias("record_cnt"))
    return flat(sums, "bts_alt_key", "record_cnt")
