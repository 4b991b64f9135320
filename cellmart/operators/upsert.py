"""Merge of a change set into a keyed table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` columns per key.

    A maximum over a struct combines on the map side, so a key changed very
    often costs one row per task instead of a sort of its whole history.
    """
    rest = [c for c in changes.columns if c not in key and c not in order]
    return (
        changes.groupBy(*key)
        .agg(F.max(F.struct(*order, *rest)).alias("_row"))
        .select(*key, "_row.*")
        .select(*changes.columns)
    )


def upsert(base: DataFrame, changes: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """``base`` (one row per key) with newer rows of ``changes`` replacing or added.

    On equal ``order`` the change wins. One full outer join on the key: a base
    table bucketed by it is read in place while its buckets are enough tasks.
    """
    columns = base.columns
    newest = latest_per_key(changes.select(*columns), key, order)
    old = base.select(*[F.col(c).alias(f"_old_{c}") for c in columns], F.lit(True).alias("_old"))
    new = newest.select(*[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_new"))
    same_key = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_new_{k}") for k in key])

    def seq(side: str) -> Column:
        return F.struct(*[F.col(f"{side}{c}").alias(c) for c in order])

    take_new = F.col("_old").isNull() | (F.col("_new").isNotNull() & (seq("_new_") >= seq("_old_")))
    return old.join(new, same_key, "full_outer").select(
        *[F.when(take_new, F.col(f"_new_{c}")).otherwise(F.col(f"_old_{c}")).alias(c) for c in columns]
    )
