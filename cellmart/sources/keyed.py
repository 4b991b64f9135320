"""A keyed table whose upserts write only what changed: base and delta files in bucket folders, merged when read."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.operators.sizing import dim_join, is_small, measured_bytes
from cellmart.operators.upsert import latest_per_key
from cellmart.session import stored
from cellmart.sources.readers import exists

BUCKETS = 64
# changed rows of a bucket from which it is worth folding them into its base
FOLD_ROWS = 1_000_000


class KeyedStore:
    """One row per key below ``path``.

    ``base/version=V/bucket=B`` holds rows, ``delta/seq=S/bucket=B`` change sets, and ``current`` names each bucket's
    base version and the last change set in it. Versions and change sets are never altered once they are named, so readers go on and a
    run that broke off is simply started again. ``order`` tells the newer of two rows; on a tie the later change set wins.
    """

    def __init__(
        self, spark: SparkSession, path: str, fields: T.StructType, key: str, order: list[str], buckets: int = BUCKETS
    ) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.fields, self.key, self.order, self.buckets = fields, key, order, buckets

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.hash(key), F.lit(self.buckets))

    def _placed(self, rows: DataFrame) -> DataFrame:
        """Rows with their bucket, a bucket's rows in one task or, if they are many, in a few."""
        return rows.select(*self.fields.names, self._bucket(F.col(self.key)).alias("bucket")).hint("rebalance", "bucket")

    def _read(self, folder: str, more: str) -> DataFrame:
        fields = T.StructType([*self.fields.fields, *T.StructType.fromDDL(more).fields])
        return self.spark.read.schema(fields).parquet(f"{self.path}/{folder}")

    def _publish(self, rows: DataFrame, upto: int, buckets: list[int]) -> None:
        version = uuid.uuid4().hex
        self._placed(rows).write.partitionBy("bucket").parquet(f"{self.path}/base/version={version}")
        named = self.spark.createDataFrame([(b, version, upto) for b in buckets], "bucket int, version string, upto long")
        named.coalesce(1).write.mode("append").parquet(f"{self.path}/current")

    def create(self, rows: DataFrame) -> None:
        """Store ``rows``, one per key, as the first base; keys are not NULL."""
        self._publish(rows.select(*self.fields.names), -1, list(range(self.buckets)))

    def apply(self, changes: DataFrame, seq: int) -> None:
        """Store a change set, reduced to the newest row per key. The same ``seq`` again replaces its own rows."""
        newest = latest_per_key(changes.select(*self.fields.names).where(F.col(self.key).isNotNull()), [self.key], self.order)
        writer = self._placed(newest).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("bucket").parquet(f"{self.path}/delta/seq={seq}")

    def _current(self) -> list[tuple[int, str, int]]:
        """Version and last change set of each bucket: a row per bucket."""
        named = self.spark.read.schema("bucket int, version string, upto long").parquet(f"{self.path}/current")
        newest = named.groupBy("bucket").agg(F.max(F.struct("upto", "version")).alias("c")).select("bucket", "c.version", "c.upto")
        return [tuple(r) for r in newest.collect()]

    def _live(self, current: list[tuple[int, str, int]]) -> tuple[DataFrame, DataFrame | None]:
        """Base rows, and changes after them with their ``seq``; both by folder, so others are not read."""

        def either(column: str, found: dict, compare) -> Column:
            parts = [compare(F.col(column), value) & F.col("bucket").isin(*buckets) for value, buckets in sorted(found.items())]
            return reduce(lambda a, b: a | b, parts)

        by_version: dict[str, list[int]] = {}
        by_seq: dict[int, list[int]] = {}
        for bucket, version, upto in current:
            by_version.setdefault(version, []).append(bucket)
            by_seq.setdefault(upto, []).append(bucket)
        base = self._read("base", "version string, bucket int").where(either("version", by_version, lambda c, v: c == v))
        if not exists(self.spark, f"{self.path}/delta"):
            return base, None
        return base, self._read("delta", "seq long, bucket int").where(either("seq", by_seq, lambda c, v: c > v))

    def _merged(self, base: DataFrame, deltas: DataFrame | None) -> DataFrame:
        names = self.fields.names
        if deltas is None:
            return base.select(*names)
        newest = stored(latest_per_key(deltas.select(*names, "seq"), [self.key], [*self.order, "seq"]), "newest")
        held = newest.select(self.key, F.struct(*names).alias("_new"))
        old, new = (F.struct(*[F.col(f"{p}{c}") for c in self.order]) for p in ("", "_new."))
        take = F.col("_new").isNotNull() & (new >= old)
        size = measured_bytes(newest)
        if not is_small(size):
            # each side is moved once
            only = F.col(self.key).isNull()
            both = base.select(*names).join(held.withColumnRenamed(self.key, "_key"), F.col(self.key) == F.col("_key"), "full_outer")
            return both.select(*[F.when(only | take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in names])
        # the base is not moved for a change set of moderate size
        replaced = dim_join(base.select(*names), held, [self.key], "left", size=size)
        kept = replaced.select(*[F.when(take, F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in names])
        keys = dim_join(base.select(self.key), newest.select(self.key), [self.key], "inner", size=size)
        added = newest.join(keys, self.key, "left_anti").select(*names)
        return kept.unionByName(added)

    def read(self) -> DataFrame:
        """The table as of the last change set."""
        return self._merged(*self._live(self._current()))

    def lookup(self, value: str) -> DataFrame:
        """The row of one key; its bucket's base and change sets are read."""
        own = (F.col("bucket") == self._bucket(F.lit(value))) & (F.col(self.key) == value)
        base, deltas = self._live(self._current())
        rows = base.where(own).select(*self.fields.names, F.lit(-1).cast("long").alias("seq"))
        if deltas is not None:
            rows = rows.unionByName(deltas.where(own).select(*self.fields.names, "seq"))
        return latest_per_key(rows, [self.key], [*self.order, "seq"]).select(*self.fields.names)

    def fold(self, rows: int = FOLD_ROWS) -> list[int]:
        """Write a new base for the buckets with at least ``rows`` changed rows; returns them. Others are not touched."""
        current = self._current()
        base, deltas = self._live(current)
        if deltas is None:
            return []
        # counts per folder
        counted = deltas.groupBy("bucket", "seq").agg(F.count(F.lit(1)).alias("n")).collect()
        last = max((r["seq"] for r in counted), default=-1)
        full = sorted(b for b in {r["bucket"] for r in counted} if sum(r["n"] for r in counted if r["bucket"] == b) >= rows)
        if full:
            chosen = F.col("bucket").isin(*full)
            self._publish(self._merged(base.where(chosen), deltas.where(chosen & (F.col("seq") <= last))), last, full)
        return full
