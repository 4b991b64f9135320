"""Mixing sources to target weights, with a curriculum: where in training each document's words come."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.llm.common import SPACE, col, fresh, matched, one_of_each, stored, text_hash
from cellmart.operators.sizing import dim_join

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
# documents of a source that are ordered together
BIN_ROWS = 4096
Knots = tuple[tuple[float, float], ...]
# relative weight over training time, from 0 to 1, for each entry of WEIGHTS: heavy sources early, light ones late
SCHEDULES: tuple[Knots, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def word_count(text: Column) -> Column:
    """Words between runs of white space; NULL has none. Nothing is split into arrays."""
    plain = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " "))
    gaps = F.length(plain) - F.length(F.replace(plain, F.lit(" "), F.lit("")))
    return F.when(plain == "", 0).otherwise(gaps + 1).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """Per source of ``sizes(source, size)``: ``source_size``, ``rows``, ``cls`` (place in the cycle of weights), ``target``.

    Targets share all sizes by weight. Sources in ascending order of ``most * size / weight`` reach their ceiling first, so
    running sums over that order tell which do, and one level serves the others. One row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cls = F.pmod(place, F.lit(len(weights))).cast("int")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), F.col("cls") + 1)
    per = per.withColumn("cls", cls).withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    ratio = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    words = F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0))
    shares = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # the level rises while sources reach their ceiling and falls from the first that does not
    per = per.withColumn("level", words / shares).withColumn("level", F.max("level").over(whole))
    share = F.least(F.col("weight") * F.col("level"), F.col("cap").cast("double"))
    return per.select("source", "source_size", "rows", "cls", F.coalesce(share, F.lit(0.0)).alias("target"))


def time_of(share: Column, knots: Knots) -> Column:
    """When a source has been asked for ``share`` (0 to 1) of its words: the inverse of its integrated schedule.

    The weight runs straight between knots, so the integral is a parabola on each segment, inverted in closed form.
    """
    segments = [(a, b, (b[0] - a[0]) * (a[1] + b[1]) / 2) for a, b in zip(knots, knots[1:], strict=False)]
    whole = sum(x for _, _, x in segments)
    done, found = 0.0, None
    for (t0, w0), (t1, w1), part in segments:
        y = F.least(F.greatest(share * whole - done, F.lit(0.0)), F.lit(part))
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * (w1 - w0) / (t1 - t0) * y, F.lit(0.0)))
        here = F.when(y > 0, F.lit(t0) + 2 * y / (w0 + root)).otherwise(F.lit(t0))
        done += part
        inside = share * whole <= done
        found = F.when(inside, here) if found is None else found.when(inside, here)
    return F.least(found.otherwise(F.lit(knots[-1][0])), F.lit(knots[-1][0]))


def _fill(part: pa.Table) -> pa.Table:
    """Of the documents at a source's limit: those taken, in order, while they fit."""
    part = part.sort_by([(c, "ascending") for c in ("h", "size", "mark")])
    left, taken = part["gap"][0].as_py(), []
    for size in part["size"].to_pylist():
        taken.append(0 < size <= left)
        left -= size if taken[-1] else 0
    return part.drop_columns("gap").append_column("extra", pa.array(taken, pa.bool_()))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most: int = MOST_REPEATS,
    schedules: Sequence[Knots] = SCHEDULES,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``mark``, ``source``, ``size``, ``source_size``, ``target``, ``copies`` and ``positions``.

    A source of size S and target T is passed through ``T // S`` times, and once more up to the rest. Its documents
    come in the order of a hash, in bins of some thousand rows: sums over bins and running sums
    within a bin place every document, so no source is ever in one task. The last pass ends inside a bin, whose documents
    are taken while they fit: the taken words stay below the target by less than the smallest
    document left in that bin. Each copy's place in its source's demand, put through the inverse
    of the source's integrated schedule, is its position in training, from 0 to 1.

    NULL is a source like any other, last in order; NULL and empty texts have size 0 and are taken only
    in whole passes. Repeated rows are rows of their own. An empty table gives an empty result; other columns are not
    read. Reruns agree: the order is a hash of id and text.
    """
    marked = docs.select(
        col(doc_id).alias("doc_id"),
        col(source).cast("string").alias("source"),
        text_hash(doc_id, text).alias("mark"),
        word_count(col(text)).alias("size"),
    )
    sized = stored(marked.withColumn("h", F.xxhash64("mark", F.lit("mix"))), "sized")
    wanted = stored(targets(sized, weights, most), "targets")
    bins = F.greatest(F.ceil(F.col("rows") / BIN_ROWS), F.lit(1)).cast("long")
    binned = dim_join(sized, wanted, ["source"], null_safe=True).withColumn("bin", F.pmod("h", bins))

    per_bin = binned.groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("target").alias("t"), F.first("source_size").alias("s"))
    running = Window.partitionBy("source").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    passes = F.when(F.col("s") > 0, F.floor(F.col("t") / F.col("s"))).otherwise(0).cast("int")
    before = F.coalesce(F.sum("words").over(running), F.lit(0))
    per_bin = per_bin.select("source", "bin", "words", passes.alias("passes"), before.alias("before"), (F.col("t") - passes * F.col("s")).alias("rest"))
    # where the last pass ends: 1 past the bin, 0 inside it, -1 before it
    ends = F.when(F.col("before") + F.col("words") <= F.col("rest"), 1).when(F.col("before") < F.col("rest"), 0)
    per_bin = stored(per_bin.withColumn("ends", ends.otherwise(-1)), "bins")
    placed = dim_join(binned, per_bin, ["source", "bin"], null_safe=True)

    inside = placed.where("ends = 0").withColumn("gap", F.col("rest") - F.col("before"))
    kinds = ", ".join(f"`{n}` {t}" for n, t in placed.dtypes)
    filled = inside.groupBy("source").applyInArrow(_fill, f"{kinds}, extra boolean")
    placed = placed.where("ends <> 0").withColumn("extra", F.col("ends") == 1).unionByName(filled)

    order = Window.partitionBy("source", "bin").orderBy(F.desc("extra"), "h", "size", "mark")
    sofar = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    copies = F.col("passes") + F.col("extra").cast("int")
    placed = placed.withColumn("start", F.col("before") + sofar).withColumn("copies", copies)

    def position(k: Column) -> Column:
        share = (k * F.col("source_size") + F.col("start")) / F.greatest(F.col("target"), F.lit(1e-9))
        cases = [(F.col("cls") == i, time_of(share, knots)) for i, knots in enumerate(schedules)]
        return reduce(lambda a, c: a.when(*c), cases[1:], F.when(*cases[0]))

    each = F.when(F.col("copies") > 0, F.transform(F.sequence(F.lit(0), F.col("copies") - 1), position))
    each = F.coalesce(each, F.array().cast("array<double>")).alias("positions")
    return placed.select("doc_id", "mark", "source", "size", "source_size", "target", "copies", each)


def training_order(docs: DataFrame, mixed: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` repeated and range-sorted as ``mixed`` says, all columns as they were; documents not taken are left out."""
    same, n, at, key, mark, origin = (fresh(docs, x) for x in ("_mark", "_n", "_at", "_key", "_key_mark", "_origin"))
    taken = stored(
        mixed.where("copies > 0")
        .groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark), F.col("source").alias(origin))
        .agg(F.flatten(F.collect_list("positions")).alias(at), F.count(F.lit(1)).alias(n)),
        "taken",
    )
    on = [(doc_id, key), (same, mark), (source, origin)]
    joined = matched(docs.withColumn(same, text_hash(doc_id, text)), taken, on, "inner")
    # rows that repeat id, text and source have their positions together: one of them stands for all
    if not taken.where(col(n) > 1).isEmpty():
        several = one_of_each(joined.where(col(n) > 1), [doc_id, same, source])
        joined = joined.where(col(n) == 1).unionByName(several)
    spread = joined.withColumn(at, F.explode(col(at)))
    ordered = spread.repartitionByRange(col(at), col(same)).sortWithinPartitions(col(at), col(same))
    return ordered.select(*[col(c) for c in docs.columns])
