"""The OR join in its three forms against the direct join."""

import random

import pytest
from pyspark.sql import functions as F

from cellmart.operators import or_join as module
from cellmart.operators import sizing
from cellmart.operators.or_join import or_bridge, or_join, or_join_sums, or_weights, through_bridge


def frames(spark, seed, rows=300, stations=40):
    rng = random.Random(seed)

    def key(prefix, n):
        return rng.choice([None, *(f"{prefix}{i}" for i in range(n))])

    facts = [
        (i, rng.choice("ab"), "c0" if rng.random() < 0.3 else key("c", 12), key("a", 8), rng.randint(0, 9))
        for i in range(rows)
    ]
    facts += facts[:20]  # exact copies
    dim = [(key("c", 10), key("a", 6), rng.choice([None, "s1", "s2", "s3"]), rng.choice("xy")) for _ in range(stations)]
    dim += dim[:5]
    return (
        spark.createDataFrame(facts, "id long, day string, cell_id string, alt_cell_id string, val long").repartition(3),
        spark.createDataFrame(dim, "cell_id string, alt_cell_id string, station string, region string"),
    )


def direct(facts, dim, how):
    d = dim.withColumnsRenamed({"cell_id": "d_c", "alt_cell_id": "d_a"})
    return facts.join(d, (F.col("cell_id") == F.col("d_c")) | (F.col("alt_cell_id") == F.col("d_a")), how).drop("d_c", "d_a")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted"])
@pytest.mark.parametrize("seed", [1, 2])
def test_rows_equal_direct_join(spark, bag, monkeypatch, how, small, seed):
    monkeypatch.setattr(module, "measured_bytes", lambda df: 0 if small else 1 << 30)
    facts, dim = frames(spark, seed)
    assert bag(or_join(facts, dim, how)) == bag(direct(facts, dim, how))


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("small", [True, False], ids=["broadcast", "salted"])
@pytest.mark.parametrize("seed", [3, 4])
def test_sums_equal_direct_join(spark, bag, monkeypatch, how, small, seed):
    monkeypatch.setattr(module, "measured_bytes", lambda df: 0 if small else 1 << 30)
    facts, dim = frames(spark, seed)
    ones = facts.withColumn("n", F.lit(1).cast("long"))
    got = or_join_sums(ones, or_weights(dim, ["station", "region"]), ["day"], ["n", "val"], ["station", "region"], how)
    wanted = (
        direct(ones, dim, how).groupBy("day", "station", "region").agg(F.sum("n").alias("n"), F.sum("val").alias("val"))
    )
    assert bag(got.select("day", "station", "region", "n", "val")) == bag(wanted)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_sums_grouped_by_the_fact_cell(spark, bag, how):
    facts, dim = frames(spark, 5)
    got = or_join_sums(facts.withColumn("n", F.lit(1).cast("long")), or_weights(dim, []), ["day", "cell_id"], ["n"], [], how)
    wanted = direct(facts, dim, how).groupBy("day", "cell_id").agg(F.count(F.lit(1)).alias("n"))
    assert bag(got) == bag(wanted)


@pytest.mark.parametrize("how", ["left", "inner"])
def test_bridge_equals_direct_join(spark, bag, how):
    facts, dim = frames(spark, 6)
    bridge = or_bridge(facts, dim, how)
    columns = [*facts.columns, "station", "region"]
    assert bag(through_bridge(facts, bridge).select(columns)) == bag(direct(facts, dim, how).select(columns))


def test_bridge_beyond_a_broadcast(spark, bag, monkeypatch):
    """The distinct pairs of all facts are made once, also where the join counts them first."""
    facts, dim = frames(spark, 6)
    wanted, made, store = bag(or_bridge(facts, dim)), [], module.stored
    monkeypatch.setattr(module, "stored", lambda df, label: made.append(label) or store(df, label))
    assert bag(or_bridge(facts, dim)) == wanted and made == []
    monkeypatch.setattr(sizing, "BROADCAST_BYTES", 4_000)
    assert bag(or_bridge(facts, dim)) == wanted and made == ["pairs"]


def test_empty_dimension(spark):
    facts, dim = frames(spark, 7)
    none = dim.where("false")
    assert or_join(facts, none, "inner").count() == 0
    assert or_join(facts, none, "left").count() == facts.count()
    left = or_join_sums(facts, or_weights(none, ["station"]), ["day"], ["val"], ["station"], "left").collect()
    assert sum(r["val"] for r in left) == facts.agg(F.sum("val")).first()[0]


def test_no_nested_loops(spark, plan, monkeypatch):
    monkeypatch.setattr(module, "measured_bytes", lambda df: 1 << 30)
    facts, dim = frames(spark, 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left", "inner"):
            weights = or_weights(dim, ["station"])
            for df in (or_join(facts, dim, how), or_join_sums(facts, weights, ["day"], ["val"], ["station"], how)):
                text = plan(df)
                assert "NestedLoop" not in text and "Cartesian" not in text
        text = plan(direct(facts, dim, "left"))
        assert "NestedLoop" in text  # what the rewrite avoids
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_do_not_multiply(spark):
    """A key shared by a third of the facts and of the stations: sums stay linear."""
    facts = spark.range(30000).select(
        F.lit("d").alias("day"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 1000)).alias("cell_id"),
        F.when(F.col("id") % 3 == 1, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 1000)).alias("alt_cell_id"),
        F.lit(1).cast("long").alias("n"),
    )
    dim = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id"))).alias("cell_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id"))).alias("alt_cell_id"),
        F.concat(F.lit("s"), F.col("id")).alias("station"),
    )
    got = or_join_sums(facts, or_weights(dim, ["station"]), ["day"], ["n"], ["station"])
    hot = {r["n"] for r in got.where("substr(station, 2) % 3 = 0").collect()}
    assert hot == {20000}  # 10,000 by cell and 10,000 by alternate cell, each station once


def test_membership_is_broadcast_beside_a_dimension_that_is_not(spark, bag, plan, monkeypatch):
    """Which keys a dimension has is much smaller than its rows: facts do not move to learn it."""
    facts, dim = frames(spark, 9)
    ones = facts.withColumn("n", F.lit(1).cast("long"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for how in ("left", "inner"):
            monkeypatch.undo()
            wanted = bag(or_join(facts, dim, how))
            monkeypatch.setattr(sizing, "BROADCAST_BYTES", 4_000)
            joined = or_join(facts, dim, how)
            text = plan(joined).split("\n\n")[0]
            assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1
            assert bag(joined) == wanted
        sums = or_join_sums(ones, or_weights(dim, ["station"]), ["day"], ["n"], ["station"], "left")
        text = plan(sums).split("\n\n")[0]
        assert text.count("BroadcastHashJoin") == 2 and text.count("SortMergeJoin") == 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
