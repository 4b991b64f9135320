"""Within-distance join of points to lines, by grid cell and exact check."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.functions.geo import distance, segment_distance
from cellmart.operators.sizing import dim_join, is_small, measured_bytes, row_bytes
from cellmart.session import stored

# lines are cut to pieces of this many cells, so a diagonal's box stays small
PIECE_CELLS = 4
# a longer line moves to a coarser level, so the cells listed for one line stay bounded
LINE_CELLS = 1024
# a line's own cells are numbered below this on its level (see _cell_side), so no point beyond can match there
CELLS_OUT = 1e13
# a cell with more pairs of a point and a line is cut into SPLIT x SPLIT smaller ones
CELL_PAIRS = 1 << 20
SPLIT = 4
# the points of dense cells are counted once for this many cuts in a row
CUTS = 3
# cells a side of the coarse ones that tell points far from every line
COARSE = 64
# stands for lengths that overflow
LONGEST = 1.7e308


def _cell(value: Column, size: Column) -> Column:
    return F.floor(value / size).cast("long")


def _covered_cells(segs: Column, reach: Column, size: Column) -> Column:
    """Cells touched by the boxes around the pieces of each segment, widened by ``reach``."""

    def piece_cells(seg: Column) -> Column:
        length = F.least(F.greatest(F.abs(seg["x2"] - seg["x1"]), F.abs(seg["y2"] - seg["y1"])), F.lit(LONGEST))
        pieces = F.greatest(F.ceil(length / (size * PIECE_CELLS)), F.lit(1)).cast("long")

        def cells(i: Column) -> Column:
            def span(a: str, b: str) -> tuple[Column, Column]:
                step = (seg[b] - seg[a]) / pieces
                start, end = seg[a] + step * i, seg[a] + step * (i + 1)
                # wider than the rounding of the cut points, far narrower than a cell
                margin = reach + F.lit(1e-6) + (F.abs(start) + F.abs(end)) * F.lit(1e-14)
                return _cell(F.least(start, end) - margin, size), _cell(F.greatest(start, end) + margin, size)

            (x0, x1), (y0, y1) = span("x1", "x2"), span("y1", "y2")
            return F.flatten(
                F.transform(
                    F.sequence(x0, x1),
                    lambda gx: F.transform(
                        # as text, which array_distinct hashes; structs it compares pair by pair
                        F.sequence(y0, y1), lambda gy: F.concat_ws("_", gx, gy)
                    ),
                )
            )

        return F.flatten(F.transform(F.sequence(F.lit(0).cast("long"), pieces - 1), cells))

    return F.array_distinct(F.flatten(F.transform(segs, piece_cells)))


def _finite(seg: Column) -> Column:
    ends = [F.abs(seg[c]) < float("inf") for c in ("x1", "y1", "x2", "y2")]
    return ends[0] & ends[1] & ends[2] & ends[3]


def _cell_side(segs: Column, reach: Column) -> Column:
    """Least useful cell width for a line: its reach, a share of its length, and
    enough to stay clear of the rounding of very large coordinates."""
    length = F.aggregate(
        segs,
        F.lit(0.0),
        lambda total, s: total + F.greatest(F.abs(s["x2"] - s["x1"]), F.abs(s["y2"] - s["y1"])),
    )
    outmost = F.array_max(
        F.transform(segs, lambda s: F.greatest(F.abs(s["x1"]), F.abs(s["y1"]), F.abs(s["x2"]), F.abs(s["y2"])))
    )
    return F.least(F.greatest(reach, length / LINE_CELLS, outmost * F.lit(1e-12)), F.lit(LONGEST / 16))


def _segments_near(segs: Column, reach: Column, size: Column, gx: Column, gy: Column) -> Column:
    """The segments whose widened box meets a cell, or a neighbour of it."""

    def meets(a: Column, b: Column, g: Column) -> Column:
        low, high = F.least(a, b) - reach, F.greatest(a, b) + reach
        return (low <= (g + 2) * size) & (high >= (g - 1) * size)

    return F.filter(segs, lambda s: meets(s["x1"], s["x2"], gx) & meets(s["y1"], s["y2"], gy))


def _touched(segs: Column, reach: Column, size: Column, gx: Column, gy: Column) -> Column:
    """The segments that come within ``reach`` of a cell, and few others: its middle is at most 0.71 cells from any of its points."""
    middle = (gx + 0.5) * size, (gy + 0.5) * size

    def near(s: Column) -> Column:
        outmost = F.greatest(*[F.abs(v) for v in (*middle, s["x1"], s["y1"], s["x2"], s["y2"])])
        # the margin covers rounding; beyond 1e100 squares overflow
        bound = reach + size + F.lit(1e-6) + outmost * F.lit(1e-11)
        return (segment_distance(*middle, s) <= bound) | (outmost > 1e100)

    return F.filter(segs, near)


def _counted(rows: DataFrame, cell: list[str], n: Column, x0: Column, x1: Column, y0: Column, y1: Column) -> DataFrame:
    sums = [F.sum(n).alias("_n"), F.min(x0).alias("_x0"), F.max(x1).alias("_x1"), F.min(y0).alias("_y0"), F.max(y1).alias("_y1")]
    return rows.groupBy(*cell).agg(*sums)


def _dense(counts: DataFrame, cell: list[str], depth: int) -> DataFrame:
    """Cells of ``counts`` with more than CELL_PAIRS pairs, whose points do not all coincide and whose smaller cells can be numbered."""
    finer = F.pow(F.lit(4.0), F.col("_level")) / float(SPLIT ** (depth + 1))
    outmost = F.greatest(*[F.abs(c) for c in ("_x0", "_x1", "_y0", "_y1")])
    apart = (F.col("_x0") < F.col("_x1")) | (F.col("_y0") < F.col("_y1"))
    many = F.col("_n").cast("double") * F.col("_m") > CELL_PAIRS
    return stored(counts.where(many & apart & (outmost / finer < CELLS_OUT)).select(*cell), "dense")


def _cut_dense(
    located: DataFrame, placed: DataFrame, listed: DataFrame, size: int, by: list[str], x: str, y: str, reach: Column
) -> tuple[DataFrame, DataFrame, bool]:
    """Points and lines by ``_depth``, the number of cuts of their cell, and whether any was cut.

    Pairs are counted per cell, and cells with more than CELL_PAIRS are cut again and again. A line moves to those of the smaller cells
    that it comes near to and that hold points, so it is listed under no cell and its parts at once. A point looks into its
    cell at every depth in use, if its first cell was cut at all; others have depth 0. ``listed`` holds the number of lines per cell of
    ``placed`` and is of at most ``size`` bytes.
    """
    cell = [*by, "_level", "_gx", "_gy"]
    one, px, py = F.lit(1), F.col(x), F.col(y)
    met = dim_join(located.select(*cell, x, y), listed, cell, "inner", size=size)
    roots = dense = _dense(_counted(met, [*cell, "_m"], one, px, px, py, py), cell, 0)
    if roots.isEmpty():
        return located.withColumn("_depth", F.lit(0)), placed.withColumn("_depth", F.lit(0)), False

    side = F.pow(F.lit(4.0), F.col("_level"))
    done = [placed.join(dense, cell, "left_anti").withColumn("_depth", F.lit(0))]
    lines = placed.join(dense, cell, "left_semi")
    depth = 0
    while not dense.isEmpty():
        # the points of cells still dense, counted at the depth of the last of these cuts; the others are sums of that
        last = float(SPLIT ** (depth + CUTS))
        here = side / float(SPLIT**depth)
        inside = located.select(*by, "_level", x, y).withColumn("_gx", _cell(px, here)).withColumn("_gy", _cell(py, here))
        inside = dim_join(inside, dense, cell, "inner").withColumn("_gx", _cell(px, side / last)).withColumn("_gy", _cell(py, side / last))
        finest = stored(_counted(inside, cell, one, px, px, py, py), "counts")
        for cut in range(1, CUTS + 1):
            depth += 1
            up = SPLIT ** (CUTS - cut)
            coarse = finest.withColumns({c: F.floor(F.col(c) / F.lit(up)).cast("long") for c in ("_gx", "_gy")}) if up > 1 else finest
            counts = stored(_counted(coarse, cell, *[F.col(c) for c in ("_n", "_x0", "_x1", "_y0", "_y1")]), "counts")
            part = F.explode(F.sequence(F.lit(0), F.lit(SPLIT * SPLIT - 1)))
            size = side / float(SPLIT**depth)
            moved = (
                lines.withColumn("_part", part)
                .withColumn("_gx", F.col("_gx") * SPLIT + F.col("_part") % SPLIT)
                .withColumn("_gy", F.col("_gy") * SPLIT + F.floor(F.col("_part") / SPLIT))
                .drop("_part")
                .withColumn("_near", _touched(F.col("_near"), reach, size, F.col("_gx"), F.col("_gy")))
                .where(F.size("_near") > 0)
            )
            lines = stored(moved.join(counts.select(*cell), cell, "left_semi").select(*placed.columns), "lines")
            listed = lines.groupBy(*cell).agg(F.count(one).alias("_m"))
            dense = _dense(counts.join(listed, cell), cell, depth)
            done.append(lines.join(dense, cell, "left_anti").withColumn("_depth", F.lit(depth)))
            if dense.isEmpty():
                break
            lines = lines.join(dense, cell, "left_semi")

    depths = F.when(F.col("_cut"), F.sequence(F.lit(1), F.lit(depth))).otherwise(F.array(F.lit(0)))
    probes = dim_join(located, roots.withColumn("_cut", F.lit(True)), cell, "left").withColumn("_depth", F.explode(depths)).drop("_cut")
    size = side / F.pow(F.lit(float(SPLIT)), F.col("_depth"))
    probes = probes.withColumn("_gx", _cell(px, size)).withColumn("_gy", _cell(py, size))
    return probes, reduce(DataFrame.unionByName, done), True


def _near_lines(located: DataFrame, cells: DataFrame, by: list[str]) -> DataFrame:
    """``located`` without the points whose coarse cell holds no line's cell, before anything is moved; all of it if those are many."""
    wide = [F.floor(F.col(c) / COARSE).cast("long").alias(f"_wide{c}") for c in ("_gx", "_gy")]
    held = stored(cells.select(*by, "_level", *wide).distinct(), "wide")
    if not is_small(measured_bytes(held)):
        return located
    held = held.withColumnsRenamed({c: f"_of_{c}" for c in (*by, "_level")})
    same = [F.col(c) == F.col(f"_of_{c}") for c in (*by, "_level")]
    same += [F.floor(F.col(c) / COARSE).cast("long") == F.col(f"_wide{c}") for c in ("_gx", "_gy")]
    return located.join(F.broadcast(held), reduce(lambda a, b: a & b, same), "left_semi")


def grid_join(
    points: DataFrame,
    lines: DataFrame,
    by: list[str],
    x: str,
    y: str,
    segs: str = "segs",
    reach: str = "reach",
) -> DataFrame:
    """One output row per (point row, line row) with equal ``by`` and distance < ``reach``.

    The result has all columns of both sides but ``segs``.

    Every line lives on one grid level whose cell is at least as wide as its
    reach (and a small share of its length) and at most four times wider, and is
    listed once under each cell it can reach into, with only the segments near that
    cell; a point looks into its own cell on each level in use. So a line meets a point at most once, duplicates on
    either side survive, and a few far-reaching lines do not coarsen the grid for
    the rest. Cells where points and lines are dense are cut further (see
    :func:`_cut_dense`): none holds more than CELL_PAIRS pairs unless its points
    coincide. Candidates that share a cell are checked by exact distance before
    anything is emitted. ``points`` is read twice, and dense parts of it once more
    for every CUTS cuts.
    """
    kept = [c for c in lines.columns if c != segs]
    width = F.col(reach).cast("double")
    # a line's cells cost far more than its row: dealt out, however few files hold the lines
    lines = lines.repartition(int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    usable = (
        lines.withColumn(segs, F.filter(segs, _finite))
        .where((F.size(segs) > 0) & (F.col(reach) > 0))
        .withColumn("_level", F.greatest(F.ceil(F.log(4.0, _cell_side(F.col(segs), width))), F.lit(0)).cast("int"))
    )
    side = F.pow(F.lit(4.0), F.col("_level"))
    placed = (
        usable.withColumn("_cell", F.explode(_covered_cells(F.col(segs), width, side)))
        .withColumn("_gx", F.split_part("_cell", F.lit("_"), F.lit(1)).cast("long"))
        .withColumn("_gy", F.split_part("_cell", F.lit("_"), F.lit(2)).cast("long"))
        .withColumn("_near", _segments_near(F.col(segs), width, side, F.col("_gx"), F.col("_gy")))
        .where(F.size("_near") > 0)
        .select(*kept, "_level", "_gx", "_gy", "_near")
    )

    placed = stored(placed, "placed")
    listed = placed.groupBy(*by, "_level", "_gx", "_gy").agg(F.count(F.lit(1)).alias("_m"), F.sum(row_bytes(placed)).alias("_bytes"))
    # the levels in use (a few dozen at most) and the sizes
    cells = listed.drop("_bytes")
    sizes = listed.groupBy("_level").agg(F.sum("_bytes").alias("bytes"), F.sum(row_bytes(cells)).alias("cells")).collect()
    if not sizes:
        extra = [c for c in kept if c not in by]
        return points.where(F.lit(False)).select(
            *points.columns, *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in extra]
        )
    levels = sorted(r["_level"] for r in sizes)
    size = sum(r["bytes"] for r in sizes)

    located = (
        points.withColumn("_level", F.explode(F.array(*[F.lit(n) for n in levels])))
        .where((F.abs(F.col(x) / side) < CELLS_OUT) & (F.abs(F.col(y) / side) < CELLS_OUT))
        .withColumn("_gx", _cell(F.col(x), side))
        .withColumn("_gy", _cell(F.col(y), side))
    )
    located = _near_lines(located, cells, by)
    located, placed, cut = _cut_dense(located, placed, cells, sum(r["cells"] for r in sizes), by, x, y, width)
    size = None if cut else size
    close = distance(F.col(x), F.col(y), F.col("_near")) < F.col(reach)
    joined = dim_join(located, placed, [*by, "_level", "_depth", "_gx", "_gy"], "inner", where=close, size=size)
    return joined.drop("_level", "_depth", "_gx", "_gy", "_near")
