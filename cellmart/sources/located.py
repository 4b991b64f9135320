"""Tables of points laid out by both coordinates, and reading the points of a box."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.operators.sizing import spread_key

# cells of a coordinate are numbered in so many bits; what lies beyond counts as the outermost cell
BITS = 31
# fixed values: shifts and masks that leave a zero between any two bits of a number
SPREAD = (
    (16, 0x0000FFFF0000FFFF),
    (8, 0x00FF00FF00FF00FF),
    (4, 0x0F0F0F0F0F0F0F0F),
    (2, 0x3333333333333333),
    (1, 0x5555555555555555),
)


def _numbered(value: Column, unit: float) -> Column:
    half = float(1 << (BITS - 1))
    # NaN is above every number; a column that is NULL stays so
    inside = F.greatest(F.least(value / unit, F.lit(half - 1)), F.lit(-half))
    return F.when(value.isNotNull(), F.floor(inside).cast("long") + (1 << (BITS - 1)))


def _spread(number: Column) -> Column:
    for shift, mask in SPREAD:
        number = F.shiftleft(number, shift).bitwiseOR(number).bitwiseAND(F.lit(mask))
    return number


def morton(x: Column, y: Column, unit: float = 1.0) -> Column:
    """The bits of both coordinates' cells of width ``unit`` in turn: points close in this order are close in the plane.

    NULL if a coordinate is.
    """
    return _spread(_numbered(x, unit)).bitwiseOR(F.shiftleft(_spread(_numbered(y, unit)), 1))


def located(df: DataFrame, x: str, y: str, unit: float = 1.0, partitions: int | None = None) -> DataFrame:
    """``df`` range-clustered and sorted by :func:`morton`, points of one cell by a hash, so one that holds very many is several files."""
    placed = df.withColumn("_code", morton(F.col(x), F.col(y), unit)).withColumn("_spread", spread_key(df))
    keys = ["_code", "_spread"]
    ranged = placed.repartitionByRange(partitions, *keys) if partitions else placed.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*keys).drop(*keys)


def write_located(
    df: DataFrame, path: str, x: str, y: str, unit: float = 1.0, partitions: int | None = None, group_bytes: int = 128 << 20
) -> None:
    """Store ``df`` in that order. Each row group covers a small part of the plane, so its smallest and largest coordinates tell most boxes
    that they need not read it, whichever coordinate they are narrow in."""
    writer = located(df, x, y, unit, partitions).write.mode("overwrite").option("compression", "zstd")
    writer.option("parquet.block.size", group_bytes).parquet(path)


def points_in_box(table: DataFrame, x: str, y: str, west: float, south: float, east: float, north: float) -> DataFrame:
    """The rows of a box, borders included; the four bounds reach the scan."""
    return table.where(F.col(x).between(west, east) & F.col(y).between(south, north))
