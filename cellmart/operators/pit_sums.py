"""Sums per window over every dated dimension row in force at each event, without joining events to dimension rows.

A key's version starts and ends cut its time into stretches in which nothing changes. Events are summed per
(window, key, stretch) first; a version then takes a window's total, or those of its stretches that lie within the version.
Rows follow change points and dimension rows, however many events a key has.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.operators.pit_join import WIDTHS, _listed, cell_of, pit_join, with_validity
from cellmart.operators.sizing import dim_join, heavy_keys, is_small, measured_bytes, parts_join
from cellmart.session import stored

# the key of events that meet no version
NO_LEG = 0


def coverage(versions: DataFrame, key: str, flag: str) -> DataFrame:
    """``key, flag, valid_from, valid_to``: the longest stretches in which at least one version of a key is in force.

    Starts and ends are summed per instant, so a version that follows another leaves nothing behind; running totals go
    per day first and along one row per day, as in :func:`with_validity`.
    """
    some = versions.where(
        F.col(key).isNotNull() & F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    )
    opened = some.select(key, F.col("valid_from").alias("_at"), F.lit(1).alias("_d"))
    closed = some.where(F.col("valid_to").isNotNull()).select(key, F.col("valid_to").alias("_at"), F.lit(-1).alias("_d"))
    steps = opened.unionByName(closed).groupBy(key, "_at").agg(F.sum("_d").alias("_d")).where("_d <> 0")
    steps = steps.withColumn("_day", F.to_date("_at"))
    along = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    days = steps.groupBy(key, "_day").agg(F.sum("_d").alias("_sum"))
    days = days.select(key, "_day", F.coalesce(F.sum("_sum").over(along), F.lit(0)).alias("_before"))
    within = Window.partitionBy(key, "_day").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    level = F.col("_before") + F.col("_upto")
    edges = steps.withColumn("_upto", F.sum("_d").over(within)).join(days, [key, "_day"])
    edges = edges.select(key, F.col("_at").alias("valid_from"), level.alias("_level"), (level - F.col("_d")).alias("_was"))
    edges = edges.where(((F.col("_level") > 0) & (F.col("_was") == 0)) | (F.col("_level") == 0))
    spans = with_validity(edges, key).where(F.col("_level") > 0)
    return spans.select(key, F.lit(True).alias(flag), "valid_from", "valid_to")


def covered(events: DataFrame, versions: DataFrame, keys: Sequence[str], at: str = "event_time") -> DataFrame:
    """``events`` (batch or stream) with ``_in_<key>``: whether a version of that key is in force at ``at``."""
    for key in keys:
        flag = f"_in_{key}"
        # stored, since the join reads it once per width of cells
        events = pit_join(events, stored(coverage(versions, key, flag), "coverage"), key, at)
        events = events.withColumn(flag, F.coalesce(flag, F.lit(False)))
    return events


def _inner_points(versions: DataFrame, keys: Sequence[str], every: str) -> DataFrame:
    """The instants inside a window at which a key's versions change, as one sorted array per key and window.

    Stations published together change at one instant, so an array is as long as a window has distinct instants.
    """
    ends = [versions.select(*keys, F.col(c).alias("_p")).where(F.col("_p").isNotNull()) for c in ("valid_from", "valid_to")]
    points = reduce(DataFrame.unionByName, ends).distinct().withColumn("_begin", F.window("_p", every)["start"])
    points = points.where(F.col("_p") > F.col("_begin")).groupBy(*keys, "_begin")
    return points.agg(F.sort_array(F.collect_set(F.unix_micros("_p"))).alias("_points"))


def _evenly_owned(dated: DataFrame, payload: list[str]) -> bool:
    """Whether no payload has more rows than the share of one task."""
    tasks = int(dated.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = heavy_keys(dated, payload)
    owned = dated.where(F.xxhash64(*payload).isin(*some)).groupBy(*payload).agg(F.count(F.lit(1)).alias("_n"))
    return (owned.agg(F.max("_n")).first()[0] or 0) <= dated.count() / tasks


def pit_sums(
    rows: DataFrame,
    versions: DataFrame,
    keys: Sequence[str],
    sums: Sequence[str],
    payload: Sequence[str],
    count: str,
    at: str = "event_time",
    every: str = "5 minutes",
) -> DataFrame:
    """``SELECT window, payload, SUM(weight * ..) FROM rows JOIN versions`` on equal ``keys`` (NULL equals NULL) and ``at`` within
    ``valid_from .. valid_to``, grouped by window and payload.

    ``rows`` hold ``window`` (of length ``every``), ``keys``, ``at`` and the whole numbers ``sums``, of which ``count`` counts
    events: a version without any in a window adds no row. ``versions`` hold ``keys``, ``payload``, ``valid_from``, ``valid_to``
    (NULL: still in force) and ``weight``. Windows are no longer than a day and within one. Three
    append-safe aggregations: on a stream each window is emitted once. In batch, a few sums per window are sent to very many
    dated rows, which are dealt by payload before: the rows of all windows and stations are then made where they are grouped.
    """
    keys, sums, payload = list(keys), list(sums), list(payload)
    points = stored(_inner_points(versions, keys, every), "points")
    # a key's events of one window are no more than a task takes
    marked = dim_join(rows.withColumn("_begin", F.col("window.start")), points, [*keys, "_begin"], "left", null_safe=True, heavy=[])
    # a number, since a second event time beside the window would be refused
    begin = F.unix_micros(F.col("window.start"))
    last = F.array_max(F.filter("_points", lambda p: p <= F.unix_micros(F.col(at))))
    marked = marked.select("window", *keys, *sums, F.coalesce(last, begin).alias("_stretch"))
    per_stretch = marked.groupBy("window", *keys, "_stretch").agg(*[F.sum(s).alias(s) for s in sums])
    per_window = per_stretch.groupBy("window", *keys).agg(
        F.collect_list(F.struct("_stretch", *sums)).alias("_parts"), *[F.sum(s).alias(s) for s in sums]
    )

    held = versions.where(F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    ended = _listed(held.where(F.col("valid_to").isNotNull()), "valid_from").withColumn("_cell", F.explode(F.sequence("_first", "_last")))
    opened = held.where(F.col("valid_to").isNull()).withColumns({"_width": F.lit(0), "_cell": F.lit(0).cast("long")})
    facts = [*payload, "weight", F.unix_micros("valid_from").alias("_from"), F.unix_micros("valid_to").alias("_to")]
    dated = reduce(DataFrame.unionByName, [x.select(*keys, F.col("_width").cast("int").alias("_width"), "_cell", *facts) for x in (ended, opened)])
    dated = stored(dated, "dated")
    on, size = [*keys, "_width", "_cell"], measured_bytes(dated)
    if not rows.isStreaming and not is_small(size):
        # stored, since it is measured first
        per_window = stored(per_window, "per_window")
    # a window meets its keys' open versions, and by each width those listed under its cell
    day = F.to_date(F.col("window.start"))
    places = [(F.lit(0), F.lit(0).cast("long")), *[(F.lit(w), cell_of(day, F.lit(w))) for w in WIDTHS]]
    spread = F.explode(F.array(*[F.struct(w.cast("int").alias("_width"), c.cast("long").alias("_cell")) for w, c in places]))
    placed = per_window.withColumn("_place", spread).select("*", "_place.*").drop("_place")
    start, end = begin, F.unix_micros(F.col("window.end"))
    overlaps = (F.col("_from") < end) & (F.col("_to").isNull() | (F.col("_to") > start))
    if is_small(size):
        joined = dim_join(placed, dated, on, "inner", where=overlaps, size=size, null_safe=True)
    elif not rows.isStreaming and is_small(placed_size := measured_bytes(placed)) and _evenly_owned(dated, payload):
        dealt = dated.repartition(int(dated.sparkSession.conf.get("spark.sql.shuffle.partitions")), *payload)
        joined = dim_join(dealt, placed, on, "inner", where=overlaps, size=placed_size, null_safe=True)
    else:
        joined = parts_join(placed, dated, on, where=overlaps, null_safe=True)
    whole = (F.col("_from") <= start) & (F.col("_to").isNull() | (F.col("_to") >= end))
    # nothing changes within a stretch: in force at its start is in force throughout
    own = F.filter("_parts", lambda x: (x["_stretch"] >= F.col("_from")) & (F.col("_to").isNull() | (x["_stretch"] < F.col("_to"))))

    def taken(name: str) -> Column:
        part = F.aggregate(own, F.lit(0).cast("long"), lambda a, x: a + x[name])
        return F.when(whole, F.col(name)).otherwise(part)

    found = joined.select("window", *payload, "weight", *[taken(s).alias(s) for s in sums]).where(F.col(count) > 0)
    return found.groupBy("window", *payload).agg(*[F.sum(F.col("weight") * F.col(s)).alias(s) for s in sums])
