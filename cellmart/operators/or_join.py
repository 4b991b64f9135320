"""Joins on ``first key equal OR second key equal`` without nested loops.

A direct OR condition leaves Spark only a nested-loop or cartesian plan. Here
each key gets its own equi-join. Equality is plain: NULL keys match nothing. A
dimension row that matches on both keys counts once.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellmart.operators.sizing import dim_join, is_small, measured_bytes
from cellmart.session import stored

KEYS = ("cell_id", "alt_cell_id")


def or_join(
    left: DataFrame, right: DataFrame, how: str = "inner", keys: tuple[str, str] = KEYS, size: int | None = None
) -> DataFrame:
    """Row-level OR join: all left columns plus the non-key columns of ``right``.

    One pass over ``left``: two membership joins tell which legs a row has, the
    row is repeated once per leg, and one equi-join on (leg, key) attaches the
    matches. A row with no leg is kept with NULLs when ``how`` is left. ``size`` is
    that of ``right`` in bytes, if known.
    """
    first, second = keys
    payload = [c for c in right.columns if c not in keys]
    size = measured_bytes(right) if size is None else size

    marked = left
    for name, flag in ((first, "_has1"), (second, "_has2")):
        members = right.select(name).where(F.col(name).isNotNull()).distinct().withColumn(flag, F.lit(True))
        # a key alone is much smaller than its rows
        marked = dim_join(marked, members, [name], "left", size=measured_bytes(members))
    has1, has2 = F.col("_has1").isNotNull(), F.col("_has2").isNotNull()
    if how == "inner":
        marked = marked.where(has1 | has2)
    legs = (
        F.when(has1 & has2, F.array(F.lit(1), F.lit(2)))
        .when(has1, F.array(F.lit(1)))
        .when(has2, F.array(F.lit(2)))
        .otherwise(F.array(F.lit(0)))
    )
    marked = marked.withColumn("_leg", F.explode(legs)).withColumn(
        "_key", F.when(F.col("_leg") == 1, F.col(first)).when(F.col("_leg") == 2, F.col(second))
    )
    stacked = reduce(
        DataFrame.unionByName,
        [
            right.where(F.col(name).isNotNull()).select(
                F.lit(leg).alias("_leg"), F.col(name).alias("_key"), F.col(first).alias("_other"), *payload
            )
            for leg, name in ((1, first), (2, second))
        ],
    )
    joined = dim_join(marked, stacked, ["_leg", "_key"], "left", size=2 * size)
    repeated = (F.col("_leg") == 2) & F.coalesce(F.col("_other") == F.col(first), F.lit(False))
    return joined.where(~repeated).select(*left.columns, *payload)


def or_bridge(facts: DataFrame, dim: DataFrame, how: str = "left", keys: tuple[str, str] = KEYS) -> DataFrame:
    """Distinct key pairs of the facts joined once to the dimension, to be stored
    and reused by every job that needs the same OR join."""
    pairs, size = facts.select(*keys).distinct(), measured_bytes(dim)
    if not is_small(2 * size):
        # the join counts them before it moves them, and they come from all facts
        pairs = stored(pairs, "pairs")
    return or_join(pairs, dim, how, keys, size)


def through_bridge(facts: DataFrame, bridge: DataFrame, keys: tuple[str, str] = KEYS) -> DataFrame:
    """Facts joined to a stored bridge on their key pair: the OR join as one equi-join.

    A bridge built with ``how`` left holds unmatched pairs too, so it yields the
    left join; one built with inner yields the inner join.
    """
    return dim_join(facts, bridge, list(keys), "inner", null_safe=True)


def _legs(first: str, second: str) -> Column:
    """One row per way to match: 1 by the first key, 2 by the second, 3 by the pair."""
    none = F.lit(None).cast("string")

    def leg(number: int, k1: Column, k2: Column) -> Column:
        return F.struct(F.lit(number).alias("leg"), k1.alias("k1"), k2.alias("k2"))

    both = leg(3, F.col(first), F.col(second))
    return F.explode(F.array(leg(1, F.col(first), none), leg(2, none, F.col(second)), both)).alias("_at")


def or_weights(dim: DataFrame, payload: list[str], keys: tuple[str, str] = KEYS) -> DataFrame:
    """The dimension prepared for :func:`or_join_sums`: rows per leg, key and payload.

    Pair rows carry a negative weight. At most three rows per dimension row; worth
    storing when several jobs share the OR join.
    """
    some_key = F.coalesce(F.col("_at.k1"), F.col("_at.k2")).isNotNull()
    both_keys = F.col("_at.k1").isNotNull() & F.col("_at.k2").isNotNull()
    sign = F.when(F.col("d_leg") == 3, -1).otherwise(1)
    return (
        dim.select(*payload, _legs(*keys))
        .where(F.when(F.col("_at.leg") == 3, both_keys).otherwise(some_key))
        .groupBy(
            F.col("_at.leg").alias("d_leg"), F.col("_at.k1").alias("d_k1"), F.col("_at.k2").alias("d_k2"), *payload
        )
        .agg(F.count(F.lit(1)).alias("copies"))
        .select("d_leg", "d_k1", "d_k2", *payload, (sign * F.col("copies")).alias("weight"))
    )


def or_join_sums(
    facts: DataFrame,
    weights: DataFrame,
    group: list[str],
    sums: list[str],
    payload: list[str],
    how: str = "inner",
    keys: tuple[str, str] = KEYS,
) -> DataFrame:
    """``SELECT group, payload, SUM(..) FROM facts OR-JOIN dim GROUP BY group, payload``
    without ever building the joined rows; ``weights`` is the dimension by :func:`or_weights`.

    The matches of a row are those on the first key, plus those on the second,
    minus those on both. So the measures are summed per key first (map-side, a
    hot key shrinks to one row per task), and each key's sum is multiplied by the
    number of dimension rows behind it: +n for a first-key or second-key match,
    -n for a match on the pair. Key sums times dimension rows is linear, even if
    one key holds a third of both sides. Measures are whole numbers, so adding and
    taking away is exact.

    With ``how`` left, pairs matching on neither key go to the NULL payload.
    ``group`` may hold a stream's window column: all steps are append-safe.
    """
    keyed = (
        facts.select(*group, *sums, _legs(*keys))
        .where((F.col("_at.leg") == 3) | F.coalesce(F.col("_at.k1"), F.col("_at.k2")).isNotNull())
        .select(*group, *sums, "_at.*")
        .groupBy(*group, "leg", "k1", "k2")
        .agg(*[F.sum(s).alias(s) for s in sums])
    )
    size = measured_bytes(weights)
    rows = weights.withColumnsRenamed({"d_leg": "leg", "d_k1": "k1", "d_k2": "k2"})
    joined = dim_join(keyed, rows, ["leg", "k1", "k2"], how, size=size, null_safe=True)
    if how == "left":
        # only the pair leg knows both keys, so it alone decides that nothing matched
        for number, column, known in ((1, "k1", "_in1"), (2, "k2", "_in2")):
            members = rows.where(F.col("leg") == number).select(F.lit(3).alias("leg"), column).distinct().withColumn(known, F.lit(True))
            joined = dim_join(joined, members, ["leg", column], "left", size=measured_bytes(members))
        unmatched = (F.col("leg") == 3) & F.col("_in1").isNull() & F.col("_in2").isNull()
        joined = joined.where(F.col("weight").isNotNull() | unmatched).withColumn(
            "weight", F.coalesce(F.col("weight"), F.lit(1))
        )
    return joined.groupBy(*group, *payload).agg(*[F.sum(F.col("weight") * F.col(s)).alias(s) for s in sums])
