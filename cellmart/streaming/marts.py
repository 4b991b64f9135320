"""Result marts kept up to date by a stream: additive partial sums per micro-batch, each counted once."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cellmart.functions.predicates import key_time, ratio
from cellmart.plans import bi
from cellmart.sources.readers import exists

POLL = "5 minutes"
# batches between two folds, by default a day of them
FOLD_EVERY = 288


@dataclass(frozen=True)
class Mart:
    """``parts`` turns facts and dimensions into rows of ``schema``: keys, then measures that add up over batches; ``month`` names
    the folder of a row, ``result`` makes the mart's columns of summed rows."""

    schema: str
    keys: tuple[str, ...]
    parts: Callable[..., DataFrame]
    month: Callable[[], Column]
    result: Callable[[DataFrame, str], DataFrame]

    @property
    def fields(self) -> T.StructType:
        return T.StructType.fromDDL(self.schema)

    @property
    def measures(self) -> list[str]:
        return [n for n in self.fields.names if n not in self.keys]

    def summed(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("month", *self.keys).agg(*[F.sum(m).alias(m) for m in self.measures])


def _volte(rows: DataFrame, run_id: str) -> DataFrame:
    return rows.select(
        F.lit(run_id).alias("run_id"),
        key_time("period").alias("window_start"),
        ratio(F.col("dropped_volte"), F.col("volte_calls")).alias("drop_rate"),
        "total_calls",
        F.col("dropped_volte").alias("dropped_calls"),
    )


def _rsrp(rows: DataFrame, run_id: str) -> DataFrame:
    return rows.select(F.lit(run_id).alias("run_id"), "base_date", "sido_name", "gungu_name", "rsrp_tot", "rsrp_u110")


MARTS = {
    "volte": Mart(
        "period string, total_calls long, dropped_volte long, volte_calls long",
        ("period",),
        lambda calls, contracts, products: bi.volte_parts(calls, contracts, products, by=bi.five_minutes()),
        lambda: F.substring("period", 1, 6),
        _volte,
    ),
    "rsrp": Mart(
        "base_date string, sido_name string, gungu_name string, rsrp_tot long, rsrp_u110 long",
        ("base_date", "sido_name", "gungu_name"),
        lambda mdt, gpot, bdri: bi.mart_rsrp(mdt, gpot, bdri, "").drop("run_id"),
        lambda: F.substring("base_date", 1, 6),
        _rsrp,
    ),
}


def add_batch(mart: Mart, facts: DataFrame, dims: Iterable[DataFrame], path: str, batch: int) -> None:
    """Store a batch's partial sums in a folder of its own.

    The batch number decides the folder: one that runs again, after a failure or a restart, replaces its own sums and adds nothing.
    """
    rows = mart.parts(facts, *dims).select(*mart.fields.names)
    rows = rows.withColumn("month", F.coalesce(mart.month(), F.lit("none"))).hint("rebalance", "month")
    # all of the folder, also months that a failed attempt left
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("month")
    writer.parquet(f"{path}/parts/batch={batch}")


def _base(spark: SparkSession, path: str) -> tuple[str | None, int]:
    """The newest folded version and the last batch in it."""
    if not exists(spark, f"{path}/folded"):
        return None, -1
    folds = spark.read.schema("version string, upto long").parquet(f"{path}/folded")
    newest = folds.agg(F.max_by("version", "upto").alias("version"), F.max("upto").alias("upto")).first()
    return newest["version"], newest["upto"]


def _partials(spark: SparkSession, mart: Mart, path: str, upto: int | None = None) -> DataFrame:
    """Rows of the newest fold and of the batches after it, as far as ``upto``."""
    version, folded = _base(spark, path)
    fields = T.StructType([*mart.fields.fields, T.StructField("month", T.StringType())])
    found = []
    if version is not None:
        found.append(spark.read.schema(fields).parquet(f"{path}/base/version={version}"))
    if exists(spark, f"{path}/parts"):
        with_batch = T.StructType([*fields.fields, T.StructField("batch", T.LongType())])
        later = spark.read.schema(with_batch).parquet(f"{path}/parts").where(F.col("batch") > folded)
        if upto is not None:
            later = later.where(F.col("batch") <= upto)
        found.append(later.select(*fields.names))
    if not found:
        return spark.createDataFrame([], fields)
    return reduce(DataFrame.unionByName, found)


def fold(spark: SparkSession, mart: Mart, path: str, upto: int) -> None:
    """Sum everything up to batch ``upto`` into one new version, named the current one last.

    Batches in it are passed over from then on, also if one of them runs again. Nothing is overwritten: a reader of the version before goes on.
    """
    if upto <= _base(spark, path)[1]:
        return
    version = uuid.uuid4().hex
    rows = mart.summed(_partials(spark, mart, path, upto))
    rows.hint("rebalance", "month").write.partitionBy("month").parquet(f"{path}/base/version={version}")
    spark.range(1).select(F.lit(version).alias("version"), F.lit(upto).cast("long").alias("upto")).write.mode("append").parquet(f"{path}/folded")


def read_mart(spark: SparkSession, mart: Mart, path: str, run_id: str, months: Iterable[str] | None = None) -> DataFrame:
    """The mart as of the last finished batch; with ``months`` (``YYYYMM``) only their folders are read."""
    rows = _partials(spark, mart, path)
    if months is not None:
        rows = rows.where(F.col("month").isin(*months))
    return mart.result(mart.summed(rows), run_id)


def keep_mart(
    mart: Mart,
    facts: DataFrame,
    dims: Iterable[DataFrame],
    path: str,
    checkpoint: str,
    fold_every: int = FOLD_EVERY,
    available_now: bool = False,
    poll: str = POLL,
) -> StreamingQuery:
    """Start a stream that adds every batch of ``facts`` to the mart; its cost follows the batch, not the facts so far.

    Dimensions are those of the start. Restarting with the same checkpoint goes on where the last run stopped.
    """
    dims = list(dims)

    def run(rows: DataFrame, batch: int) -> None:
        add_batch(mart, rows, dims, path, batch)
        if (batch + 1) % fold_every == 0:
            fold(rows.sparkSession, mart, path, batch)

    writer = facts.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=poll)).start()
