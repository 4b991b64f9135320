"""Dense row numbers and exact quantiles without a global sort in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.operators.sizing import spread_key
from cellmart.session import shared_dir, stored

_LOCAL_BITS = 33  # monotonically_increasing_id keeps the partition above bit 33


def row_index(df: DataFrame, name: str, order_by: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """Number rows 0..n-1 in column ``name``; returns the frame and n.

    Each partition numbers its own rows and adds the count of the partitions
    before it. Rows are numbered in ``order_by`` order after a range shuffle (a hash
    breaks ties, so a hot value still splits), or in scan order without any shuffle. The numbered rows are checkpointed before they are
    counted: both passes then read the same partitions, also after a task is lost.
    """
    spark = df.sparkSession
    shared_dir(spark)
    if order_by:
        order = [*order_by, "_spread"]
        df = (
            df.withColumn("_spread", spread_key(df))
            .repartitionByRange(*order)
            .sortWithinPartitions(*order)
            .drop("_spread")
        )
    numbered = df.withColumn("_position", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("_position", _LOCAL_BITS)
    # one row per partition, however many rows there are
    counts = numbered.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["_part"], total))
        total += row["count"]
    local = F.col("_position").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    starts = F.broadcast(spark.createDataFrame(offsets, "_part long, _start long"))
    indexed = (
        numbered.withColumn("_part", part)
        .join(starts, "_part", "left")
        .withColumn(name, local + F.col("_start"))
        .drop("_part", "_start", "_position")
    )
    return indexed, total


def exact_quantiles(
    df: DataFrame,
    group: list[str],
    value: str,
    probs: dict[str, float],
    parts: int | None = None,
) -> DataFrame:
    """Interpolated quantiles per group, one column per entry of ``probs``.

    Values are counted per distinct value and stored once, dealt out in ranges of (group, value): ``parts`` of them, or as many as
    shuffles have. Totals per group and part tell which part holds each wanted rank; only those parts are read again, and
    within each the running counts find the value. A group with very many values lies in many parts, so no task sorts it whole.
    """
    df = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    # the group as one struct: structs compare NULL fields as equal, so a NULL group joins too
    named, keys = F.struct(*group).alias("_group"), ["_group", "_part"]
    counted = df.groupBy(named, F.col(value).cast("double").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    ranged = counted.repartitionByRange(parts, "_group", "_v") if parts else counted.repartitionByRange("_group", "_v")
    rows = stored(ranged.withColumn("_part", F.spark_partition_id()), "counts")

    upto = F.sum("_in").over(Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, 0))
    whole = F.sum("_in").over(Window.partitionBy("_group"))
    totals = rows.groupBy(*keys).agg(F.sum("_n").alias("_in")).select(*keys, (upto - F.col("_in")).alias("_before"), upto.alias("_upto"), whole.alias("_total"))
    wanted = []
    for name, p in probs.items():
        rank = F.lit(float(p)) * (F.col("_total") - 1)
        for side, row in (("lo", F.floor(rank)), ("hi", F.ceil(rank))):
            wanted.append(F.struct(F.lit(name).alias("name"), F.lit(side).alias("side"), rank.alias("rank"), row.cast("long").alias("row")))
    # a few rows per group
    targets = totals.withColumn("_t", F.explode(F.array(*wanted))).where((F.col("_t.row") >= F.col("_before")) & (F.col("_t.row") < F.col("_upto")))
    targets = targets.select(*keys, "_before", "_t.*")
    held = targets.groupBy(*keys).agg(F.first("_before").alias("_before"), F.collect_list(F.struct("name", "side", "rank", "row")).alias("_ts"))
    within = Window.partitionBy(*keys).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    last = F.col("_before") + F.sum("_n").over(within)
    found = rows.join(held, keys).select("_group", "_v", last.alias("_last"), (last - F.col("_n")).alias("_first"), "_ts")
    hits = F.filter("_ts", lambda t: (t["row"] >= F.col("_first")) & (t["row"] < F.col("_last")))
    found = found.select("_group", "_v", F.inline(hits))

    def interpolated(name: str) -> Column:
        def at(side: str) -> Column:
            return F.max(F.when((F.col("name") == name) & (F.col("side") == side), F.col("_v")))

        rank = F.max(F.when(F.col("name") == name, F.col("rank")))
        # equal neighbours may be infinite
        between = at("lo") + (at("hi") - at("lo")) * (rank - F.floor(rank))
        return F.when(at("lo") == at("hi"), at("lo")).otherwise(between)

    return found.groupBy("_group").agg(*[interpolated(n).alias(n) for n in probs]).select("_group.*", *probs)
