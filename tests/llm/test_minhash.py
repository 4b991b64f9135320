import random

import corpus_pipeline
import numpy as np
import pytest
from test_simhash import slow_components

from cellmart.llm import minhash, simhash


def similarity(a, b):
    x, y = (set(zip(*[t.lower().split()[i:] for i in range(5)], strict=False)) for t in (a, b))
    return len(x & y) / len(x | y)


def edited_copies(words):
    """Texts of 100 to 300 words, each with copies that differ in one to eight words."""
    rng, rows = random.Random(4), []
    for i in range(20):
        base = words(i, 100 + 10 * i, 1 << 40)
        rows.append((len(rows), " ".join(base)))
        for edits in (1, 2, 4, 8):
            other = list(base)
            for at in rng.sample(range(len(base)), edits):
                other[at] = f"edited{i}x{edits}x{at}"
            rows.append((len(rows), " ".join(other)))
    return rows


def test_the_stage_drops_every_pair_of_the_wanted_similarity(spark, docs_of, words, tmp_path):
    rows = edited_copies(words)
    texts = dict(rows)
    expected = slow_components(sorted(texts), lambda a, b: similarity(texts[a], texts[b]) >= 0.8)
    got = {r.doc_id: r.component_id for r in minhash.similar_groups(docs_of(rows)).collect()}
    assert got == expected and 20 < len(set(got.values())) < len(rows)
    kept = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs_of(rows), str(tmp_path))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))


def test_a_large_group_is_connected(docs_of, words):
    base = words(1, 120, 1 << 40)
    rows = [(i, " ".join([*base[: i % 120], f"own{i}", *base[i % 120 + 1 :]])) for i in range(300)]
    assert {r.component_id for r in minhash.similar_groups(docs_of(rows)).collect()} == {0}


def pairs_made(monkeypatch, docs, counted):
    """Groups of ``docs``, and how many pairs were verified."""
    made = []

    def watched(df, label, plain=minhash.stored):
        out = plain(df, label)
        if label == "pairs":
            made.append(out.count())
        return out

    with monkeypatch.context() as patch:
        patch.setattr(minhash, "stored", watched)
        groups = {r.doc_id: r.component_id for r in minhash.similar_groups(docs).collect()}
    counted.append(sum(made))
    return groups


@pytest.mark.parametrize(("length", "edits"), [(120, 4), (170, 2)])
def test_pairs_of_near_copies_below_the_limit_grow_with_their_number(monkeypatch, docs_of, words, length, edits):
    """Every two share bands, few or none are similar enough: pairs must not grow with the square of the group."""
    base, counted = words(1, length, 1 << 40), []
    for n in (200, 800):
        rng, rows = random.Random(5), []
        for i in range(n):
            other = list(base)
            for at in rng.sample(range(length), edits):
                other[at] = f"own{i}x{at}"
            rows.append((i, " ".join(other)))
        got = pairs_made(monkeypatch, docs_of(rows), counted)
        if n == 200:
            texts = dict(rows)
            assert got == slow_components(sorted(texts), lambda a, b: similarity(texts[a], texts[b]) >= 0.8)
    assert counted[1] <= 6 * counted[0] + 1000 and counted[1] < 60 * 800


def test_sizes_that_differ_still_meet(docs_of, words):
    """Texts that hold a common one with parts of their own, near the limit from both sides."""
    base, rows = words(2, 200, 1 << 40), []
    for i in range(60):
        cut = base[: 200 - i % 30]
        rows.append((i, " ".join([*cut, *(f"tail{i}x{k}" for k in range(i % 7 * 5))])))
    texts = dict(rows)
    expected = slow_components(sorted(texts), lambda a, b: similarity(texts[a], texts[b]) >= 0.8)
    assert {r.doc_id: r.component_id for r in minhash.similar_groups(docs_of(rows)).collect()} == expected


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(1)
    for n, other in ((5, 5), (300, 280), (4000, 100), (0, 7)):
        a, b = (np.unique(rng.integers(0, 1 << 63, k, np.uint64) * np.uint64(2)) for k in (n, other))
        b = np.union1d(b, a[: n // 2])
        apart = sum((int(x) ^ int(y)).bit_count() for x, y in zip(minhash.parity(a).view(np.uint64), minhash.parity(b).view(np.uint64), strict=True))
        assert apart <= len(np.setxor1d(a, b)) and apart % 2 == len(np.setxor1d(a, b)) % 2


def test_awkward_rows(awkward, docs_of):
    kept = minhash.drop_similar(awkward)
    assert kept.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "3", "6", "8"]
    assert minhash.similar_groups(awkward.limit(0)).count() == 0
    nameless = docs_of([(None, "same words here"), (None, "same words  here"), (None, "other words there")])
    assert minhash.drop_similar(nameless).count() == 2


def test_fingerprints_name_candidates(docs_of, words, spark):
    """The near stage goes by SimHash too: fingerprints near each other name pairs, whole sets decide, without any band."""
    rows = [(i, " ".join(words(i, 400, 1 << 40))) for i in range(6)]
    rows += [(10 + i, rows[i][1] + f" other{i}") for i in range(6)] + [(20, "one two three four five"), (21, "")]
    prints = {i: simhash.fingerprint(t, minhash.SHINGLE) for i, t in rows if t}
    near = slow_components(sorted(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= simhash.DISTANCE)
    found = minhash.signatures(docs_of(rows))
    nodes = found.selectExpr("node", "n", "bands", "parity", "struct(doc_id, mark, fp) AS row").cache()
    ids = {r.node: r.row.doc_id for r in nodes.collect()}
    pairs = minhash.fingerprint_pairs(nodes)
    met = {tuple(sorted((ids[r.u], ids[r.v]))) for r in pairs.collect()}
    assert slow_components(sorted(prints), lambda a, b: (a, b) in met or (b, a) in met) == near and len(set(near.values())) < len(near)
    members = nodes.selectExpr("0L AS key", "0 AS band", "node", "n", "parity").where("false")
    sets = minhash._sets(docs_of(rows), nodes, "doc_id", "text", minhash.SHINGLE).cache()
    stars = minhash.components(members, nodes, sets, named=pairs.cache()).collect()
    assert {frozenset((ids[r.node], ids[r.root])) for r in stars} == {frozenset(p) for p in met}
