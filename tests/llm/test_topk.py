import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellmart.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label string"


def brute(rows, k=20):
    good = [(i, [math.floor(64 * float(np.float32(x))) for x in v]) for i, v, _ in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in good:
        if q % 20 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in good if i != q)
            out += [(q, r, i, -s) for r, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


def found(spark, rows, k=20, partitions=5):
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, k).collect()
    return sorted((r.query_id, r.rank, r.vec_id, r.score) for r in got)


def vectors(seed, n, dims=16, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dims) * scale], "x") for i in range(n)]


@pytest.mark.parametrize("scale", [0.01, 1.0, 3000.0])
def test_equals_brute_force(spark, scale):
    rows = vectors(1, 300, scale=scale)
    assert found(spark, rows) == brute(rows)


def test_ties_in_a_hot_group(spark, monkeypatch):
    monkeypatch.setattr(topk, "AT_ONCE", 64)
    monkeypatch.setattr(topk, "QUERY_ROWS", 6)
    rows = [(i, [0.5, 0.25] if i % 3 else [float(i % 7), 0.1], "x") for i in range(400)]
    assert found(spark, rows) == brute(rows)


def test_vectors_that_take_no_part(spark):
    rows = [*vectors(2, 30, 3), (40, None, "x"), (60, [1.0, None, 2.0], "x"), (80, [1.0, math.nan, 0.0], "x"), (100, [math.inf, 0.0, 0.0], "x"), (None, [9.0, 9.0, 9.0], "x")]
    assert found(spark, rows) == brute(rows)
    few = vectors(3, 5)
    assert found(spark, few) == brute(few) and len(brute(few)) == 4
    assert found(spark, []) == [] and found(spark, vectors(3, 1)) == []
    repeated = [*vectors(4, 50, 4), (7, [9.0, 9.0, 9.0, 9.0], "y"), (7, [9.0, 9.0, 9.0, 9.0], "y")]
    assert found(spark, repeated) == brute(repeated)
    mixed = [*vectors(5, 30, 4), (31, [1.0], "x"), (33, [], "x")]
    assert found(spark, mixed) == brute(mixed)


def test_scores_beyond_doubles_stay_exact(spark):
    rows = [(i, [float(2**22 + i), float(2**21 - i), 1.0], "x") for i in range(0, 60)]
    assert found(spark, rows) == brute(rows)


def test_products_by_halves_are_exact_or_stop(spark):
    rng = np.random.default_rng(1)
    a, b = (np.floor(rng.normal(size=(n, 70)) * 2.0**25) for n in (5, 7))
    whole = np.vectorize(int, otypes=[object])
    assert (topk._exact_products(a, b) == whole(a) @ whole(b).T).all()
    with pytest.raises(OverflowError, match="a score beyond"):
        topk._exact_products(a * 2.0**16, b)
    with pytest.raises(Exception, match="OverflowError"):
        found(spark, [(0, [1e12, 1.0], "x"), (1, [1e12, 1.0], "x")])
