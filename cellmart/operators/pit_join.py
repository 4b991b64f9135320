"""Point-in-time join: each event meets the dimension version valid at its time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.operators.sizing import dim_join, heavy_keys, is_small, measured_bytes
from cellmart.session import stored

# widths, in days, of the cells a version may be listed under, and how many cells of one width it may take
WIDTHS = (1, 32, 1024, 32768)
CELLS = 32
# versions of a key up to which they are one row
PACKED = 64


def with_validity(
    snapshots: DataFrame, key: str, valid_from: str = "valid_from", ties: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``valid_to``: the start of the next version of the same key, NULL for the last.

    Two levels keep every window small: versions are ordered within (key, day),
    and only one row per day is ordered along a key, so a key with very many
    versions never has to be sorted as one group. Versions of one key with equal
    ``valid_from`` get an empty validity except the last by ``ties``.
    """
    dated = snapshots.where(F.col(key).isNotNull() & F.col(valid_from).isNotNull()).withColumn(
        "_day", F.to_date(valid_from)
    )
    within = Window.partitionBy(key, "_day").orderBy(valid_from, *ties)
    along = Window.partitionBy(key).orderBy("_day")
    days = (
        dated.groupBy(key, "_day")
        .agg(F.min(valid_from).alias("_opens"))
        .withColumn("_next_day", F.lead("_opens").over(along))
        .select(key, "_day", "_next_day")
    )
    return (
        dated.withColumn("_next", F.lead(valid_from).over(within))
        .join(days, [key, "_day"])
        .withColumn("valid_to", F.coalesce("_next", "_next_day"))
        .select(*snapshots.columns, "valid_to")
    )


def _listed(versions: DataFrame, valid_from: str) -> DataFrame:
    """Ended versions with the widths and the first and last cell of days they are listed under."""
    days = F.datediff("valid_to", valid_from) + 1
    width = F.coalesce(*[F.when(days <= w * CELLS, w) for w in WIDTHS[:-1]], F.lit(WIDTHS[-1]))
    ended = versions.where(F.col(valid_from) < F.col("valid_to")).withColumn("_width", width)
    first, last = (cell_of(F.to_date(c), F.col("_width")) for c in (valid_from, "valid_to"))
    return ended.withColumn("_first", first).withColumn("_last", last)


def cell_of(day: Column, width: Column) -> Column:
    return F.floor(F.unix_date(day) / width)


def pit_join(
    events: DataFrame, versions: DataFrame, key: str, at: str = "event_time", valid_from: str = "valid_from"
) -> DataFrame:
    """Left join of ``events`` (batch or stream) to the version in force at ``at``.

    ``versions`` carries ``valid_to`` from :func:`with_validity`. Versions of a key with up to
    ``PACKED`` are one row, so events are moved once at most and look through their key's versions where they are.
    Those of other keys: ended versions
    are listed under cells of a day, a month, some years or a century, the narrowest that needs
    about ``CELLS`` of them, and joined on (key, cell) once for each width in use; the one open
    version of a key is joined on the key alone. An event is compared with the versions of its own
    cells only, and matches at most one version.
    """
    payload = [c for c in versions.columns if c not in (key, valid_from, "valid_to")]
    # stored, since it is read several times
    versions = stored(versions.where(F.col(key).isNotNull()), "versions")
    held = F.struct(*[F.col(c) for c in payload], F.lit(True).alias("_hit"))
    counted = versions.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    long = stored(counted.where(F.col("_n") > PACKED).select(key), "long")
    some_long = not long.isEmpty()
    short = versions.join(long, key, "left_anti") if some_long else versions
    packed = short.groupBy(key).agg(
        F.collect_list(F.struct(F.col(valid_from).alias("_from"), F.col("valid_to").alias("_to"), held.alias("_held"))).alias("_short")
    )
    # a stream reads it for every batch
    packed = stored(packed, "packed") if events.isStreaming else packed
    size = measured_bytes(versions)
    heavy = None if is_small(size) or events.isStreaming else heavy_keys(events, [key])
    matched = dim_join(events, packed, [key], "left", size=size, heavy=heavy)
    own = F.filter("_short", lambda v: (F.col(at) >= v["_from"]) & (v["_to"].isNull() | (F.col(at) < v["_to"])))
    matched = matched.withColumn("_version", F.get(own, F.lit(0))["_held"]).drop("_short")
    if some_long:
        matched = _by_cells(matched, versions.join(long, key, "left_semi"), key, at, valid_from, held, heavy)
    return matched.select(*events.columns, *[F.col(f"_version.{c}").alias(c) for c in payload])


def _by_cells(
    events: DataFrame, versions: DataFrame, key: str, at: str, valid_from: str, held: Column, heavy: list[int] | None
) -> DataFrame:
    """``events`` with the NULLs in ``_version`` replaced by ``held`` of the version in force, found by its cells."""
    current = versions.where(F.col("valid_to").isNull()).select(
        key, F.col(valid_from).alias("_open_from"), held.alias("_open")
    )
    ended = _listed(versions, valid_from).select(
        key,
        "_width",
        F.explode(F.sequence("_first", "_last")).alias("_cell"),
        F.col(valid_from).alias("_from"),
        F.col("valid_to").alias("_to"),
        held.alias("_ended"),
    )
    size = measured_bytes(current.select(key, "_open.*").unionByName(ended.select(key, "_ended.*")))
    matched = dim_join(events, current, [key], "left", where=F.col(at) >= F.col("_open_from"), size=size, heavy=heavy)
    found = []
    # one row per width in use
    for width in sorted(r["_width"] for r in ended.select("_width").distinct().collect()):
        start, end, hit = (f"{c}_{width}" for c in ("_from", "_to", "_ended"))
        own = ended.where(F.col("_width") == width).drop("_width")
        matched = dim_join(
            matched.withColumn("_cell", cell_of(F.to_date(at), F.lit(width))),
            own.withColumnsRenamed({"_from": start, "_to": end, "_ended": hit}),
            [key, "_cell"],
            "left",
            where=(F.col(at) >= F.col(start)) & (F.col(at) < F.col(end)),
            size=size,
            by=[key],
            heavy=heavy,
        ).drop("_cell", start, end)
        found.append(F.when(F.col(f"{hit}._hit"), F.col(hit)))
    version = F.coalesce("_version", *found, F.col("_open"))
    return matched.select(*[c for c in events.columns if c != "_version"], version.alias("_version"))
