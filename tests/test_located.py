"""Tables laid out by both coordinates."""

import glob
import random

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from cellmart.sources.located import morton, points_in_box, write_located

BOX = (200.0, 300.0, 320.0, 400.0)


def groups_met(path, box):
    """Row groups whose ranges meet the box, of how many."""
    met, all_groups = 0, 0
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        for i in range(meta.num_row_groups):
            ranges = {meta.row_group(i).column(c).path_in_schema: meta.row_group(i).column(c).statistics for c in range(meta.num_columns)}
            all_groups += 1
            x, y = ranges["x"], ranges["y"]
            met += x.min <= box[2] and x.max >= box[0] and y.min <= box[3] and y.max >= box[1]
    return met, all_groups


def test_codes_take_bits_in_turn(spark):
    places = [(0.0, 0.0), (5.5, -3.25), (-1e30, 1e30), (float("nan"), 0.0), (float("inf"), float("-inf")), (None, 1.0), (1234.0, 98765.0)]
    df = spark.createDataFrame(places, "x double, y double")

    def number(v):
        return (1 << 31) - 1 if v != v else int(min(max(v, -(2.0**30)), 2.0**30 - 1) // 1) + (1 << 30)

    def code(x, y):
        bits = [((number(v) if v == v else (1 << 31) - 1) >> i & 1) << (2 * i + at) for at, v in enumerate((x, y)) for i in range(31)]
        return sum(bits)

    got = [r[0] for r in df.select(morton(F.col("x"), F.col("y"))).collect()]
    assert got == [None if x is None else code(x, y) for x, y in places]


def test_boxes_skip_row_groups(spark, bag, plan, tmp_path):
    rng = random.Random(4)
    rows = [(i, rng.uniform(-1000, 1000), rng.uniform(-1000, 1000)) for i in range(40_000)] + [(50_000 + i, 250.0, 350.0) for i in range(2_000)]
    rows += [(-1, None, 350.0), (-2, 250.0, None), (-3, 320.0, 400.0), (-4, 320.1, 400.0)]
    points = spark.createDataFrame(rows, "id long, x double, y double")
    path, plain = str(tmp_path / "located"), str(tmp_path / "plain")
    write_located(points, path, "x", "y", partitions=32)
    points.repartitionByRange(32, "x").write.parquet(plain)
    table = spark.read.parquet(path)
    found = points_in_box(table, "x", "y", *BOX)
    wanted = [r[0] for r in rows if None not in r and BOX[0] <= r[1] <= BOX[2] and BOX[1] <= r[2] <= BOX[3]]
    assert sorted(r["id"] for r in found.collect()) == sorted(wanted) and -3 in wanted and -4 not in wanted
    assert bag(table) == bag(points)
    # narrow in either coordinate, few of the groups; ordered by one coordinate, a box that is narrow in the other meets them all
    for box in ((-1000.0, 100.0, 1000.0, 110.0), (100.0, -1000.0, 110.0, 1000.0)):
        met, groups = groups_met(path, box)
        assert groups >= 30 and met <= groups // 2
    assert groups_met(plain, (-1000.0, 100.0, 1000.0, 110.0))[0] >= 30
    text = plan(found)
    assert "GreaterThanOrEqual(x,200.0)" in text and "LessThanOrEqual(y,400.0)" in text


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    write_located(spark.createDataFrame([], "x double, y double"), path, "x", "y")
    assert points_in_box(spark.read.schema("x double, y double").parquet(path), "x", "y", *BOX).count() == 0
