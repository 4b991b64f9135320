import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellmart.llm import centroids

SCHEMA = "vec_id long, embedding array<double>"


def slow(rows, clusters=16, rounds=3, dims=64):
    good = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in good if i is not None)[:clusters]
    centres = [v for _, v in first]
    if not centres:
        return []
    for turn in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres)) for _, v in good]
        if turn < rounds:
            for n in range(len(centres)):
                own = [v for (_, v), (_, m) in zip(good, near, strict=True) if m == n]
                if own:
                    centres[n] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    total = sum(d for d, _ in near)
    of = [sum(d for d, m in near if m == n) for n in range(len(centres))]
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, of[n], total, names[n]) for (i, _), (d, n) in zip(good, near, strict=True)), key=repr)


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return sorted((tuple(r) for r in centroids.cluster(df, **options).collect()), key=repr)


def some(seed, n, dims=64, scale=1.0):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in rng.normal(size=dims) * scale]) for i in range(n)]


def test_equals_brute_force(spark):
    rows = some(1, 150)
    assert found(spark, rows) == slow(rows)


def test_components_beyond_doubles_stay_exact(spark):
    rows = some(2, 50, scale=3e5)
    assert found(spark, rows) == slow(rows)


def test_ties_and_copies(spark):
    rows = [(i, [float(i % 3), float(i % 2)] + [0.0] * 62) for i in range(80)] + [(100 + i, [0.5] * 64) for i in range(50)]
    assert found(spark, rows) == slow(rows)


def test_awkward_rows(spark):
    rows = [*some(3, 10), (None, [1.0] * 64), (None, [1.0] * 64), (3, [0.5] * 64), (3, [0.25] * 64)]
    rows += [(60, None), (61, [1.0] * 63), (62, [1.0] * 65), (63, []), (64, [math.nan] * 64), (65, [math.inf] * 64), (66, [None] * 64)]
    assert found(spark, rows) == slow(rows)
    assert found(spark, []) == [] and found(spark, [(None, [1.0] * 64)]) == []
    assert found(spark, some(4, 1)) == slow(some(4, 1))


def test_clashing_columns(spark):
    df = spark.createDataFrame(some(5, 30), SCHEMA)
    more = df.selectExpr("*", "'x' AS v", "1 AS cluster", "'c' AS h", "2 AS inertia")
    assert sorted(centroids.cluster(more).collect()) == sorted(centroids.cluster(df).collect())


def test_bounds(spark):
    with pytest.raises(ValueError, match="bisectors"):
        centroids.cluster(spark.createDataFrame([], SCHEMA), clusters=5000)
    with pytest.raises(Exception, match="fits no long"):
        found(spark, [(1, [1e14] * 64), (2, [-1e14] * 64), (None, [0.0] * 64)], rounds=0)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 20), st.integers(1, 5), st.sampled_from([1, 3, 200, 10**7, 6 * 10**8]))
def test_tournament_finds_the_nearest(seed, k, dims, reach):
    rng = np.random.default_rng(seed)
    centres, x = rng.integers(-reach, reach + 1, (k, dims)), rng.integers(-reach, reach + 1, (50, dims))
    number, distance = centroids.Bisectors(centres).nearest(np.r_[x, centres])
    apart = np.r_[x, centres].astype(object)[:, None] - centres.astype(object)[None]
    squares = (apart * apart).sum(2)
    assert number.tolist() == [int(np.argmin(s)) for s in squares] and distance.tolist() == [min(s) for s in squares]
