"""Geometry expressions and the grid join against brute force."""

import importlib
import random

import pytest
from pyspark.sql import functions as F

from cellmart.functions.geo import segments, with_segments, wkt_distance, wkt_points
from cellmart.operators import sizing
from cellmart.operators.grid_join import grid_join
from cellmart.plans.batch import mdt_merge
from cellmart.sources.readers import literal_rows


@pytest.mark.parametrize(
    "wkt, x, y, expected",
    [
        ("POINT(3 4)", 0, 0, 5.0),
        ("point ( -3  4.0 )", 0, 0, 5.0),
        ("LINESTRING(0 0, 10 0, 10 10)", 5, 3, 3.0),
        ("LINESTRING(0 0, 10 0)", 13, 4, 5.0),
        ("LINESTRING (0 0,0 0)", 3, 4, 5.0),
        ("LINESTRING(1e1 0, 2E1 0)", 0, 0, 10.0),
        ("POLYGON((0 0, 1 0, 1 1, 0 0))", 0, 0, None),
        ("POINT EMPTY", 0, 0, None),
        ("LINESTRING(0 0)", 0, 0, None),
        ("POINT(1)", 0, 0, None),
        ("POINT(1 2", 0, 0, None),
        ("", 0, 0, None),
        (None, 0, 0, None),
        ("POINT(1 2)", None, 0, None),
    ],
)
def test_distance(spark, wkt, x, y, expected):
    df = spark.createDataFrame([(wkt, x, y)], "g string, x int, y int")
    assert df.select(wkt_distance(F.col("x").cast("double"), F.col("y").cast("double"), F.col("g"))).first()[0] == expected


def test_segments_of_points(spark):
    df = spark.createDataFrame([("POINT(1 2)",), ("LINESTRING(0 0, 1 0, 1 1)",)], "g string")
    sizes = [r[0] for r in df.select(F.size(segments(wkt_points(F.col("g"))))).collect()]
    assert sizes == [1, 2]
    assert with_segments(df, "g").columns == ["segs"]


def random_lines(rng, n):
    lines = []
    for i in range(n):
        x, y = rng.uniform(-300, 300), rng.uniform(-300, 300)
        if i % 4 == 0:
            wkt = f"POINT({x} {y})"
        else:
            points = [(x, y)]
            for _ in range(rng.randint(1, 4)):
                points.append((points[-1][0] + rng.uniform(-150, 150), points[-1][1] + rng.uniform(-150, 150)))
            wkt = f"LINESTRING({', '.join(f'{a} {b}' for a, b in points)})"
        lines.append((i, wkt, rng.choice([0, 1, 2, 5, 20, 40, None, -3]), rng.choice(["v1", "v2"])))
    return [*lines, (900, None, 5, "v1"), (901, "junk", 5, "v1"), (902, lines[1][1], 20, "v1"), (902, lines[1][1], 20, "v1")]


@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted"])
@pytest.mark.parametrize("seed", [1, 2])
def test_grid_equals_brute_force(spark, bag, monkeypatch, small, seed):
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 1 << 40 if small else -1)
    rng = random.Random(seed)
    points = [(i, rng.uniform(-400, 400), rng.uniform(-400, 400), rng.choice(["v1", "v2"])) for i in range(800)]
    points += [(0, *points[0][1:]), (990, None, 1.0, "v1"), (991, 0.0, 0.0, None)]
    p = spark.createDataFrame(points, "id long, x double, y double, vendor string")
    shapes = spark.createDataFrame(random_lines(rng, 60), "line long, g string, cnt int, vendor string").withColumn(
        "reach", F.col("cnt").cast("long") * 3
    )
    got = grid_join(p, with_segments(shapes, "g"), ["vendor"], "x", "y")
    brute = p.join(shapes, "vendor").where(wkt_distance(F.col("x"), F.col("y"), F.col("g")) < F.col("reach"))
    wanted = bag(brute, "id", "line")
    assert bag(got, "id", "line") == wanted and len(wanted) > 100


@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted"])
@pytest.mark.parametrize("pairs", [4, 40], ids=["deep", "some"])
def test_dense_cells_are_cut(spark, bag, monkeypatch, small, pairs):
    """Clusters of points on long lines, and many equal points: no match is lost or doubled."""
    module = importlib.import_module("cellmart.operators.grid_join")
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 1 << 40 if small else -1)
    monkeypatch.setattr(module, "CELL_PAIRS", pairs)
    rng = random.Random(5)
    points = [(i, rng.gauss(0, 120), rng.gauss(0, 60), "v1") for i in range(200)]
    points += [(200 + i, 7.25, -3.5, "v1") for i in range(60)] + [(300 + i, rng.uniform(-400, 400), 3.0, "v2") for i in range(60)]
    p = spark.createDataFrame(points, "id long, x double, y double, vendor string")
    through = [(500 + i, f"LINESTRING(-200 {i}, 200 -{i + 4})", 4, "v1") for i in range(4)]
    shapes = spark.createDataFrame([*random_lines(rng, 40), *through], "line long, g string, cnt int, vendor string")
    shapes = shapes.withColumn("reach", F.col("cnt").cast("long") * 3)
    got = grid_join(p, with_segments(shapes, "g"), ["vendor"], "x", "y")
    brute = p.join(shapes, "vendor").where(wkt_distance(F.col("x"), F.col("y"), F.col("g")) < F.col("reach"))
    wanted = bag(brute, "id", "line")
    assert bag(got, "id", "line") == wanted and len(wanted) > 100


def test_no_cell_keeps_more_pairs_than_stated(spark, monkeypatch):
    module = importlib.import_module("cellmart.operators.grid_join")
    monkeypatch.setattr(module, "CELL_PAIRS", 200)
    seen = []

    def join(located, listed, on, *rest, **options):
        if "_depth" in on:
            per = [df.groupBy(*on).count().withColumnRenamed("count", n) for df, n in ((located, "n"), (listed, "m"))]
            spread = located.groupBy(*on).agg((F.count_distinct("x", "y") > 1).alias("apart"))
            seen.extend(per[0].join(per[1], on).join(spread, on).select(F.col("n") * F.col("m"), "apart").collect())
        return dim_join(located, listed, on, *rest, **options)

    dim_join = sizing.dim_join
    monkeypatch.setattr(module, "dim_join", join)
    rng = random.Random(6)
    points = [(i, rng.gauss(0, 3), rng.gauss(0, 3), "v") for i in range(2000)] + [(5000 + i, 1.0, 1.0, "v") for i in range(300)]
    p = spark.createDataFrame(points, "id long, x double, y double, vendor string")
    lines = spark.createDataFrame([(f"POINT({i % 5} {i // 5})", 2, "v") for i in range(25)], "g string, reach int, vendor string")
    matches = grid_join(p, with_segments(lines, "g"), ["vendor"], "x", "y").count()
    apart = [n for n, several in seen if several]
    assert matches > 5000 and max(apart) <= 200 and max(n for n, _ in seen) > 200


def test_threshold_is_open(spark):
    p = spark.createDataFrame([(1, 3.0, 0.0, "v"), (2, 2.999999, 0.0, "v")], "id long, x double, y double, vendor string")
    line = spark.createDataFrame([("POINT(0 0)", 3, "v")], "g string, reach int, vendor string")
    assert [r["id"] for r in grid_join(p, with_segments(line, "g"), ["vendor"], "x", "y").collect()] == [2]


def test_reaches_of_very_different_size(spark):
    """A far-reaching line keeps its own level: all its points are found, and the
    short ones stay on fine cells."""
    p = spark.range(-500, 500).select("id", (F.col("id") * 40.0).alias("x"), F.lit(0.0).alias("y"), F.lit("v").alias("vendor"))
    lines = spark.createDataFrame(
        [("POINT(0 0)", 15000, "v"), ("POINT(400 0)", 3, "v"), ("LINESTRING(-20000 0, 20000 0)", 1, "v")],
        "g string, reach int, vendor string",
    )
    got = grid_join(p, with_segments(lines, "g"), ["vendor"], "x", "y")
    assert {r["reach"]: r["count"] for r in got.groupBy("reach").count().collect()} == {15000: 749, 3: 1, 1: 1000}


def test_extreme_coordinates(spark, bag):
    inf, nan = float("inf"), float("nan")
    places = [(1.0, 1.0), (inf, 0.0), (nan, 0.0), (0.0, -inf), (1e15, 1e15), (3e17, 0.0), (1e6, 1e6), (5e5, 5e5 + 2),
              (5.0, 1.0), (1.1e18, 0.0), (1e100, 1e100), (1e300, 0.0), (-1e150, 2.0), (1e18, 0.5)]
    p = spark.createDataFrame([(i, x, y, "v") for i, (x, y) in enumerate(places)], "id long, x double, y double, vendor string")
    texts = ["POINT(0 0)", "POINT(1e15 1e15)", "POINT(3e17 0)", "POINT(1e400 0)", "LINESTRING(0 0, 1e6 1e6)",
             "LINESTRING(0 0, 1e7 1e7, 1e400 0)", "LINESTRING(0 0, 2000000000000000000 0)", "POINT(1.1e18 0)",
             "POINT(1e100 1e100)", "POINT(1e300 0)", "POINT(-1e150 2)"]
    lines = spark.createDataFrame([(i, g, 3, "v") for i, g in enumerate(texts)], "line int, g string, reach int, vendor string")
    got = grid_join(p, with_segments(lines, "g"), ["vendor"], "x", "y")
    brute = p.join(lines, "vendor").where(wkt_distance(F.col("x"), F.col("y"), F.col("g")) < F.col("reach"))
    assert bag(got, "id", "line") == bag(brute, "id", "line")
    assert {(r["id"], r["line"]) for r in got.collect()} >= {(0, 0), (4, 1), (5, 2), (6, 4), (7, 4), (7, 5), (8, 6), (9, 7), (10, 8), (11, 9), (12, 10), (13, 6)}


def test_no_usable_line(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0, "v")], "id long, x double, y double, vendor string")
    lines = spark.createDataFrame([("bad", 3, "v")], "g string, reach int, vendor string")
    out = grid_join(p, with_segments(lines, "g"), ["vendor"], "x", "y")
    assert out.columns == ["id", "x", "y", "vendor", "reach"] and out.count() == 0


MDT = ["mdt_id", "gnss_utmkx", "gnss_utmky", "bts_market_nm", "trigr_ev", "base_date"]


def test_mdt_merge_rules(spark, bag):
    rows = []
    for vendor in ("ERICSSON", "NOKIA", "SAMSUNG", "OTHER"):
        for trigger in ("PERIODIC", None, ""):
            rows.append((f"{vendor}-{trigger}", 0.0, 1.0, vendor, trigger, "20251201"))
    rows.append(("far", 0.0, 100.0, "NOKIA", None, "20251201"))
    rows.append(("edge", 0.0, 6.0, "NOKIA", None, "20251201"))
    rows.append(("other day", 0.0, 1.0, "NOKIA", None, "20251202"))
    mdt = literal_rows(spark, "cdr_mdt_smsng", rows, MDT)
    lines = [(i, "LINESTRING(-10 0, 10 0)", 2, v) for i, v in enumerate(("ERICSSON", "NOKIA", "SAMSUNG", "OTHER"))]
    lines += [(10, "POINT(0 0)", 1, "NOKIA"), (11, None, 50, "NOKIA"), (12, "POINT(0 0)", None, "NOKIA")]
    rpot = literal_rows(spark, "tbm_rpot_m", lines)
    stations = [
        ("e", "E1", "ERICSSON", "POINT(0 4)"),
        ("n", "N1", "NOKIA", "POINT(3 5)"),
        ("n", "N2", "NOKIA", None),
        ("s", "S1", "SAMSUNG", "POINT(0 1)"),
    ]
    bts = literal_rows(spark, "bts_master", stations, ["cell_id", "bts_alt_key", "bts_market_nm", "rpot_geom"])
    out = mdt_merge(mdt, bts, rpot, "20251201")
    got = sorted((r["mdt_id"], r["bts_alt_key"], r["distance_m"]) for r in out.where("bts_alt_key <> 'N2'").collect())
    assert got == [
        ("ERICSSON-PERIODIC", "E1", 3.0),
        ("NOKIA-None", "N1", 5.0),  # near two lines: twice per station
        ("NOKIA-None", "N1", 5.0),
        ("SAMSUNG-", "S1", 0.0),
    ]
    assert [r["distance_m"] for r in out.where("bts_alt_key = 'N2'").collect()] == [None, None]
    assert mdt_merge(mdt, bts, rpot, ["20251201", "20251202"]).count() == 10


def test_mdt_merge_plan(spark, plan, tmp_path):
    rows = [(f"m{i}", float(i), 0.0, "NOKIA", None, f"2025120{i % 5}") for i in range(100)]
    path = str(tmp_path / "mdt")
    literal_rows(spark, "cdr_mdt_smsng", rows, MDT).write.partitionBy("base_date").parquet(path)
    rpot = literal_rows(spark, "tbm_rpot_m", [(1, "POINT(0 0)", 2, "NOKIA")])
    bts = literal_rows(spark, "bts_master", [("n", "N1", "NOKIA", "POINT(3 5)")], ["cell_id", "bts_alt_key", "bts_market_nm", "rpot_geom"])
    text = plan(mdt_merge(spark.read.schema(literal_rows(spark, "cdr_mdt_smsng", rows, MDT).schema).parquet(path), bts, rpot, "20251201"))
    assert "NestedLoop" not in text and "Cartesian" not in text and "SortMergeJoin" not in text
    assert "PartitionFilters: [isnotnull(base_date" in text


def test_points_far_from_every_line_are_not_moved(spark, monkeypatch):
    """Points whose coarse cell holds no line drop out before any join that may move them."""
    module = importlib.import_module("cellmart.operators.grid_join")
    moved, joined = [], sizing.dim_join

    def join(located, listed, on, *rest, **options):
        moved.append(located.count())
        return joined(located, listed, on, *rest, **options)

    monkeypatch.setattr(module, "dim_join", join)
    p = spark.range(1000).selectExpr("id", "CAST(id * 5000 AS double) AS x", "0.0D AS y", "'v' AS vendor")
    lines = spark.createDataFrame([("POINT(3 0)", 9, "v"), ("POINT(-5000 0)", 9, "v")], "g string, reach int, vendor string")
    assert [r["id"] for r in grid_join(p, with_segments(lines, "g"), ["vendor"], "x", "y").collect()] == [0]
    assert moved and max(moved) <= 2


def test_many_stations_are_dealt_out(spark, bag, plan, monkeypatch):
    """Stations beyond what is broadcast meet few hits without being repeated or sorted."""
    mdt = literal_rows(spark, "cdr_mdt_smsng", [(f"m{i}", float(i), 1.0, "NOKIA", None, "20251201") for i in range(30)], MDT)
    rpot = literal_rows(spark, "tbm_rpot_m", [(1, "POINT(0 0)", 2, "NOKIA")])
    shapes = ["POINT({i} 2)", "LINESTRING({i} 9, {i} 3)", "LINESTRING(90 90, 80 {i}, 70 70, 1 {i}, -9 4)", None]
    stations = [("n", f"N{i}", "NOKIA", (shapes[i % 4] or "POLYGON").format(i=i)) for i in range(400)]
    bts = literal_rows(spark, "bts_master", stations, ["cell_id", "bts_alt_key", "bts_market_nm", "rpot_geom"])
    few = mdt_merge(mdt, bts, rpot)
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 4 * 8000)
    many = mdt_merge(mdt, bts, rpot)
    assert "SortMergeJoin" not in plan(many)
    parsed = bts.withColumn("d", wkt_distance(F.lit(3.0), F.lit(1.0), F.col("rpot_geom")))
    direct = {r["bts_alt_key"]: r["d"] for r in parsed.collect()}
    assert {r["bts_alt_key"]: r["distance_m"] for r in many.where("mdt_id = 'm3'").collect()} == direct
    assert many.count() == 6 * 400 and bag(many) == bag(few)
