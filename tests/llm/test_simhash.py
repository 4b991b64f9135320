import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from cellmart.llm import simhash
from cellmart.llm.components import connected


def slow_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(items, near):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(items, 2):
        if near(a, b):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in items}


@pytest.mark.parametrize("text", ["", None, " \n", "One", "one TWO", "a b c d", "É é x  y\tz ß", "a " * 70_000, "x" * 100_000])
def test_fingerprint_is_the_majority_of_hashes(text):
    assert simhash.fingerprint(text) & (1 << 64) - 1 == slow_fingerprint(text)


def test_hash_is_sparks(spark):
    from pyspark.sql import functions as F

    got = spark.sql("SELECT 'one two three' AS s").select(F.xxhash64("s")).first()[0]
    assert got & (1 << 64) - 1 == xxhash.xxh64(b"one two three", seed=42).intdigest()


def fingerprints_for(seed, n):
    """Skewed and correlated bits, with clusters and chains of small distances."""
    rng = random.Random(seed)
    out = set()
    while len(out) < n:
        base = rng.getrandbits(64) & rng.choice([(1 << 64) - 1, 0xFFFF0000FFFF, 0xFFFFFFFF])
        out.add(base)
        for _ in range(rng.randrange(12)):
            for _ in range(rng.randrange(1, 5)):
                base ^= 1 << rng.randrange(64)
            out.add(base)
    return sorted(x - (1 << 64) if x >> 63 else x for x in out)


@pytest.mark.parametrize("bucket_rows", [1 << 15, 50])
def test_links_connect_what_brute_force_connects(spark, bucket_rows):
    values = fingerprints_for(1, 900)
    df = spark.createDataFrame([(v,) for v in values], "fp long").repartition(5)
    found = simhash.links(df, bucket_rows=bucket_rows).collect()
    mask = (1 << 64) - 1
    assert all(0 < ((r.u ^ r.v) & mask).bit_count() <= 3 for r in found)
    expected = slow_components(values, lambda a, b: ((a ^ b) & mask).bit_count() <= 3)
    got = slow_components(values, lambda a, b, e={(min(r.u, r.v), max(r.u, r.v)) for r in found}: (min(a, b), max(a, b)) in e)
    assert got == expected


def test_a_dense_bucket_needs_few_links():
    rng = random.Random(5)
    values = np.array(list({1 << rng.randrange(64) | 1 << rng.randrange(64) for _ in range(4000)}), np.uint64)
    us, vs = simhash._bucket_links(np.zeros(len(values), np.int64), values, 3)
    assert len(us) <= len(values)


def test_any_allocation_covers_the_distance():
    cost, thresholds = simhash.allocate([[0, 5, 9, 30, 80], [0, 1, 2, 90, 99], [0, 50, 60, 70, 80]], 3)
    assert sum(t + 1 for t in thresholds) == 4
    assert cost == min(
        a + b + c
        for i, a in enumerate([0, 5, 9, 30, 80])
        for j, b in enumerate([0, 1, 2, 90, 99])
        for k, c in enumerate([0, 50, 60, 70, 80])
        if i + j + k == 4
    )


def test_groups_partition_the_bits_and_keep_ties_together():
    rng = np.random.default_rng(0)
    bits = rng.integers(0, 2, (2000, 64))
    bits[:, 40] = bits[:, 3]
    both = bits.T @ bits
    groups = simhash.group_bits(2000, both, 4)
    assert sorted(b for g in groups for b in g) == list(range(64))
    assert next(g for g in groups if 3 in g) == next(g for g in groups if 40 in g)


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1100)]
    got = {r.node: r.root for r in connected(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = sorted({x for e in edges for x in e})
    pairs = {(min(e), max(e)) for e in edges}
    expected = slow_components(nodes, lambda a, b: (a, b) in pairs)
    assert {n: got.get(n, n) for n in nodes} == expected
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_documents(docs_of, awkward, words):
    base = words(1, 400)
    rows = [(i, " ".join(words(i, 30 + i))) for i in range(10, 60)]
    for i in range(100, 140):
        edited = list(base)
        if i % 2:
            edited[i % 400] = "edited"
        rows.append((i, " ".join(edited)))
    got = simhash.near_groups(docs_of(rows)).collect()
    prints = {i: slow_fingerprint(t) for i, t in rows}
    expected = slow_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 3)
    assert {r.doc_id: r.component_id for r in got} == expected
    kept = simhash.drop_near_copies(docs_of(rows)).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(expected.values()))

    got = {(r.doc_id, r.fp): r.component_id for r in simhash.near_groups(awkward).collect()}
    assert {c for (_, fp), c in got.items() if fp == 0} == {3}
    kept = simhash.drop_near_copies(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "6", "8"]
    assert simhash.near_groups(awkward.limit(0)).count() == 0
    nameless = docs_of([(None, "same words here"), (None, "same words here"), (None, "other words there")])
    assert simhash.drop_near_copies(nameless).count() == 2
