"""Geometry text and planar distance as column expressions (metres, no projection)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The text forms accepted, everything else parses to NULL.
_NUMBER = r"[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?"
_PAIR = rf"({_NUMBER})\s+({_NUMBER})"
_POINT = rf"(?i)^\s*POINT\s*\(\s*{_NUMBER}\s+{_NUMBER}\s*\)\s*$"
_LINE = (
    rf"(?i)^\s*LINESTRING\s*\(\s*{_NUMBER}\s+{_NUMBER}\s*(?:,\s*{_NUMBER}\s+{_NUMBER}\s*)+\)\s*$"
)


def wkt_points(wkt: Column) -> Column:
    """POINT or LINESTRING text to ``array<struct<x, y>>``; NULL for anything else."""
    xs = F.regexp_extract_all(wkt, F.lit(_PAIR), F.lit(1))
    ys = F.regexp_extract_all(wkt, F.lit(_PAIR), F.lit(2))
    points = F.transform(
        F.arrays_zip(xs.alias("x"), ys.alias("y")),
        lambda p: F.struct(p["x"].cast("double").alias("x"), p["y"].cast("double").alias("y")),
    )
    return F.when(wkt.rlike(_POINT) | wkt.rlike(_LINE), points)


def segments(points: Column) -> Column:
    """Consecutive point pairs; a single point becomes one segment of length zero."""

    def pair(a: Column, b: Column) -> Column:
        return F.struct(
            a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")
        )

    count = F.greatest(F.size(points) - 1, F.lit(1))
    ends = F.slice(points, F.least(F.size(points), F.lit(2)), count)
    return F.zip_with(F.slice(points, 1, count), ends, pair)


def with_segments(df: DataFrame, wkt: str, name: str = "segs") -> DataFrame:
    """Replace geometry text by its segments. The points are a column of their own
    in between, so the text is parsed once per row and not once per use."""
    parsed = df.withColumn("_points", wkt_points(F.col(wkt)))
    return parsed.withColumn(name, segments(F.col("_points"))).drop("_points", wkt)


def segment_distance(px: Column, py: Column, seg: Column | dict[str, Column]) -> Column:
    """Distance from a point to a closed segment."""
    dx, dy = seg["x2"] - seg["x1"], seg["y2"] - seg["y1"]
    along = ((px - seg["x1"]) * dx + (py - seg["y1"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.coalesce(F.greatest(F.lit(0.0), F.least(F.lit(1.0), along)), F.lit(0.0))
    ex, ey = px - (seg["x1"] + t * dx), py - (seg["y1"] + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def distance(px: Column, py: Column, segs: Column) -> Column:
    """Distance from a point to the nearest segment; NULL without geometry."""
    nearest = F.array_min(F.transform(segs, lambda s: segment_distance(px, py, s)))
    return F.when(px.isNotNull() & py.isNotNull(), nearest)


def flat_ends(segs: Column, name: str, n: int) -> dict[str, Column]:
    """The ends of the first ``n`` segments as plain columns ``<name>_x1_0 ..``, and the further segments, if any, as ``name``."""
    ends = {f"{name}_{c}_{i}": F.get(segs, F.lit(i))[c] for i in range(n) for c in ("x1", "y1", "x2", "y2")}
    return {**ends, name: F.when(F.size(segs) > n, F.slice(segs, n + 1, F.size(segs)))}


def flat_distance(px: Column, py: Column, name: str, n: int) -> Column:
    """:func:`distance` to segments held as :func:`flat_ends`: compiled, but for lines of more than ``n`` segments."""
    flat = [{c: F.col(f"{name}_{c}_{i}") for c in ("x1", "y1", "x2", "y2")} for i in range(n)]
    return F.least(*[segment_distance(px, py, seg) for seg in flat], distance(px, py, F.col(name)))


def wkt_distance(px: Column, py: Column, wkt: Column) -> Column:
    return distance(px, py, segments(wkt_points(wkt)))
