"""The size check and the salted join."""

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from cellmart import session
from cellmart.operators import sizing
from cellmart.operators.sizing import BROADCAST_BYTES, REPEAT_BYTES, dim_join, measured_bytes, salt_count


def test_measured_size_sees_content(spark):
    narrow = spark.range(100).select(F.col("id").cast("string").alias("k"))
    wide = narrow.withColumn("text", F.repeat(F.lit("x"), 10_000))
    lists = narrow.withColumn("a", F.sequence(F.lit(1), F.lit(1000)))
    assert measured_bytes(narrow) < 10_000
    assert measured_bytes(wide) > 1_000_000 and measured_bytes(lists) > 1_000_000
    assert measured_bytes(narrow.where("false")) == 0


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_equals_broadcast(spark, bag, how, null_safe):
    fact = spark.range(600).select(
        "id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, None).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("k")
    )
    dim = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("zz", 5)], "k string, v int")
    one = dim_join(fact, dim, ["k"], how, size=0, null_safe=null_safe)
    other = dim_join(fact, dim, ["k"], how, size=BROADCAST_BYTES + 1, null_safe=null_safe)
    assert bag(one) == bag(other) and one.columns == other.columns == ["id", "k", "v"]


@pytest.mark.parametrize("copies", [False, True], ids=["distinct rows", "one row copied"])
def test_hot_key_spreads_over_tasks(spark, copies):
    fact = spark.range(0, 8000, 1, 50).select((F.lit(1) if copies else F.col("id")).alias("id"), F.lit("hot").alias("k"))
    dim = spark.createDataFrame([("hot", 1)], "k string, v int")
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = dim_join(fact, dim, ["k"], size=BROADCAST_BYTES + 1)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(sizes) == 8000 and len(sizes) >= 8 and max(sizes) < 8000 / 3


def test_salts_follow_cluster_and_size(spark):
    spark.conf.set("spark.sql.shuffle.partitions", "2000")
    try:
        df = spark.range(1)
        assert salt_count(df, 1) == 2000
        assert salt_count(df, REPEAT_BYTES // 100) == 100
        assert salt_count(df, REPEAT_BYTES) == 8
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_unsupported_join(spark):
    with pytest.raises(ValueError):
        dim_join(spark.range(1), spark.range(1), ["id"], "full")


def test_shared_folder_comes_from_the_session(spark: SparkSession):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert session.shared_dir(spark) == configured
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")
    assert session.scratch_path(spark, "x").startswith(configured)


def test_only_hot_keys_are_repeated(spark, bag, plan):
    """A dimension too large to broadcast is moved once but for the rows of keys that are hot in the fact."""
    fact = spark.range(4000).select("id", F.when(F.col("id") % 2 == 0, -1).otherwise(F.col("id")).alias("k"))
    dim = spark.range(-1, 4000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("v"))
    heavy = sizing.heavy_keys(fact, ["k"])
    hot = fact.where("k = -1").select(F.xxhash64("k")).first()[0]
    assert hot in heavy and len(heavy) <= 4
    assert sizing.heavy_keys(fact.where("false"), ["k"]) == []
    joined = dim_join(fact, dim, ["k"], size=BROADCAST_BYTES + 1)
    assert bag(joined) == bag(dim_join(fact, dim, ["k"], size=0))
    assert "Generate" not in plan(dim_join(fact, dim, ["k"], size=BROADCAST_BYTES + 1, heavy=[]))


def test_keys_of_different_types_meet(spark, bag):
    fact = spark.range(400).select("id", F.lit(7).cast("int").alias("k"))
    dim = spark.range(10).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert bag(dim_join(fact, dim, ["k"], size=BROADCAST_BYTES + 1)) == bag(dim_join(fact, dim, ["k"], size=0))


def test_rows_of_one_key_are_dealt_over_parts(spark, bag, monkeypatch):
    monkeypatch.setattr(sizing, "PART_ROWS", 10)
    sums = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3), (None, 4), ("none", 5)], "k string, s int")
    dim = spark.range(1000).select(F.when(F.col("id") < 900, "hot").when(F.col("id") < 950, None).otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("k"), "id")
    for null_safe in (True, False):
        parts = sizing.parts_join(sums, dim, ["k"], where=F.col("id") % 2 == 0, null_safe=null_safe)
        assert bag(parts) == bag(dim_join(sums, dim, ["k"], "inner", where=F.col("id") % 2 == 0, size=0, null_safe=null_safe))
        assert parts.columns == ["k", "s", "id"]
    settings = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        dealt = [r["count"] for r in parts.where("k = 'hot'").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(dealt) == 900 and max(dealt) < 300


def test_a_plan_holds_several_dimensions(spark, plan):
    """Several dimensions of a plan are held by the driver at once, so one alone may not take all that is broadcast."""
    fact, dim = spark.range(100).withColumnRenamed("id", "k"), spark.range(10).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(dim_join(fact, dim, ["k"], size=BROADCAST_BYTES // 8))
        assert "BroadcastHashJoin" not in plan(dim_join(fact, dim, ["k"], size=BROADCAST_BYTES // 2, heavy=[]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
