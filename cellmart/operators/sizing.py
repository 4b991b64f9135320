"""Joins of a large fact to a dimension of unknown size, without hot tasks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.session import stored

BROADCAST_BYTES = 64 * 1024 * 1024
# a plan holds several dimensions at once, so each may take this share of what is broadcast
SHARES = 4
# what repeating a dimension's hot keys for every salt may add to a shuffle, over the whole cluster
REPEAT_BYTES = 4 * 1024 * 1024 * 1024
MIN_SALTS = 8
# rows of a dimension that one task meets with all facts of their key
PART_ROWS = 8192


def row_bytes(df: DataFrame) -> Column:
    """Size of one row's values."""
    width: Column = F.lit(16)
    for field in df.schema.fields:
        name = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            width = width + F.coalesce(F.octet_length(name), F.lit(0)) + 8
        elif isinstance(field.dataType, T.ArrayType):
            element = field.dataType.elementType
            slots = len(element.fields) if isinstance(element, T.StructType) else 1
            width = width + F.greatest(F.coalesce(F.size(name), F.lit(0)), F.lit(0)) * (8 * slots + 16)
        else:
            width = width + 8
    return width.cast("long")


def measured_bytes(df: DataFrame) -> int:
    """Size of the values in ``df``, by one aggregation that returns one row.

    Plan estimates are guesses after explodes and joins; a broadcast is only
    allowed on this measurement.
    """
    return df.agg(F.sum(row_bytes(df)).alias("bytes")).first()["bytes"] or 0


def spread_key(df: DataFrame) -> Column:
    """A hash that differs between the rows of a hot key, and between copies of one
    row in different input partitions.

    It depends on the row's content and partition, never on the order rows arrive
    in, so a task that runs again after a loss sends every row to the same place.
    """
    return F.xxhash64(*df.columns, F.spark_partition_id())


def salt_count(df: DataFrame, size: int) -> int:
    """As many salts as there are shuffle partitions, while a dimension of ``size``
    bytes can be repeated that often within the budget."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(MIN_SALTS, min(tasks, REPEAT_BYTES // max(size, 1)))


def is_small(size: int) -> bool:
    """Whether a dimension of ``size`` bytes is broadcast."""
    return size <= BROADCAST_BYTES // SHARES


def heavy_keys(fact: DataFrame, on: list[str]) -> list[int]:
    """Hashes of the keys that fill more than one shuffle partition's share of ``fact``, and perhaps of some others.

    One pass without a shuffle (Misra-Gries); at most as many numbers as there are shuffle partitions reach the driver.
    """
    tasks = int(fact.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hashed = fact.select(F.xxhash64(*on).alias("_hash"))
    return list(hashed.stat.freqItems(["_hash"], max(1 / tasks, 2e-4)).first()[0] or [])


def _equal(pairs: list[tuple[Column, Column]], null_safe: bool) -> Column:
    return reduce(lambda a, b: a & b, [k.eqNullSafe(r) if null_safe else k == r for k, r in pairs])


def dim_join(
    fact: DataFrame,
    dim: DataFrame,
    on: list[str],
    how: str = "left",
    where: Column | None = None,
    size: int | None = None,
    null_safe: bool = False,
    by: list[str] | None = None,
    heavy: list[int] | None = None,
) -> DataFrame:
    """Join row-level facts to a dimension on equal ``on`` columns.

    A dimension measured to be small (or of known ``size`` in bytes) is broadcast,
    so the fact is not moved at all. Beyond the limit both sides are shuffled on
    the key and a salt, which only keys that are hot in the fact have: such a fact row takes one salt (see
    :func:`spread_key`), their dimension rows are repeated for every salt, and all other dimension rows are
    moved once. ``heavy`` are the hashes of the hot keys, by the columns ``by`` out of ``on``, if they are known already (see
    :func:`heavy_keys`). A stream cannot be counted before it starts; there every key has MIN_SALTS salts
    unless ``heavy`` is given. AQE splits what is still uneven.

    Apart from ``on`` the two sides share no column names; ``where`` may use
    columns of both. With ``null_safe`` NULL keys equal each other.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    size = measured_bytes(dim) if size is None else size
    renamed = {k: f"_dim_{k}" for k in on}
    right = dim.withColumnsRenamed(renamed)
    condition = _equal([(F.col(k), F.col(r)) for k, r in renamed.items()], null_safe)
    if where is not None:
        condition = condition & where
    if is_small(size):
        return fact.join(F.broadcast(right), condition, how).drop(*renamed.values())
    by = by or on
    # equal values of different types have different hashes
    hashed = all(fact.schema[k].dataType == dim.schema[k].dataType for k in by)
    if hashed and heavy is None and not fact.isStreaming:
        heavy = heavy_keys(fact, by)
    if hashed and heavy is not None:
        if not heavy:
            return fact.join(right, condition, how).drop(*renamed.values())
        salts = salt_count(fact, size)
        hot, dim_hot = (F.xxhash64(*[F.col(c) for c in names]).isin(*heavy) for names in (by, [renamed[k] for k in by]))
    else:
        salts, hot, dim_hot = MIN_SALTS, F.lit(True), F.lit(True)
    salt = F.when(hot, F.pmod(spread_key(fact), F.lit(salts))).otherwise(0).cast("int")
    fact = fact.withColumn("_salt", salt)
    right = right.withColumn("_dim_salt", F.explode(F.sequence(F.lit(0), F.when(dim_hot, F.lit(salts - 1)).otherwise(F.lit(0)))))
    joined = fact.join(right, condition & (F.col("_salt") == F.col("_dim_salt")), how)
    return joined.drop("_salt", "_dim_salt", *renamed.values())


def parts_join(sums: DataFrame, dim: DataFrame, on: list[str], where: Column | None = None, null_safe: bool = False) -> DataFrame:
    """Inner join of facts that are summed up already (batch or stream) to a dimension that may hold very many rows of one key.

    The other way round than :func:`dim_join`: a key's dimension rows are dealt over as many parts as keep each to about
    PART_ROWS, and the facts of such a key, few by then, are repeated for every part. No dimension row is repeated. ``dim`` is read twice.
    """
    renamed = {k: f"_dim_{k}" for k in on}
    right = dim.withColumnsRenamed(renamed)
    condition = _equal([(F.col(k), F.col(r)) for k, r in renamed.items()], null_safe)
    if where is not None:
        condition = condition & where
    # a row per PART_ROWS rows of the dimension at most
    counted = dim.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > PART_ROWS)
    large = stored(counted.withColumn("_cuts", F.ceil(F.col("_n") / PART_ROWS).cast("int")).drop("_n"), "large")
    one = F.coalesce("_cuts", F.lit(1))

    def marked(rows: DataFrame, names: list[str]) -> DataFrame:
        found = large.withColumnsRenamed({k: f"_large_{k}" for k in on})
        same = [F.col(c).eqNullSafe(F.col(f"_large_{k}")) for c, k in zip(names, on, strict=True)]
        return rows.join(F.broadcast(found), reduce(lambda a, b: a & b, same), "left").drop(*[f"_large_{k}" for k in on])

    right = marked(right, [renamed[k] for k in on]).withColumn("_dim_part", F.pmod(F.xxhash64(*right.columns), one)).drop("_cuts")
    sums = marked(sums, on).withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), (one - 1).cast("long")))).drop("_cuts")
    joined = sums.join(right, condition & (F.col("_part") == F.col("_dim_part")), "inner")
    return joined.drop("_part", "_dim_part", *renamed.values())
