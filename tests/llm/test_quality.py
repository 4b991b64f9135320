import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from cellmart.llm import quality

LABELS = "doc_id long, quality int, toxic int"


def prose(seed, bad):
    rng = random.Random(seed)
    words = [f"{rng.choice('bcdfg')}{rng.choice('aeiou')}{rng.choice('lmnr')}{rng.choice('aeiou')}t" for _ in range(rng.randrange(30, 200))]
    if bad == 1:
        return " ".join(w.upper() + "!!" for w in words)
    if bad == 2:
        return " ".join([words[0]] * 40 + [words[1]] * 40)
    if bad == 3:
        return " ".join(w + rng.choice(["$$$", "%%%", "&&&"]) for w in words)
    return "\n".join(" ".join(words[i : i + 12]).capitalize() + "." for i in range(0, len(words), 12))


@pytest.fixture
def corpus(spark, docs_of):
    rng = random.Random(3)
    kinds = [rng.choice([0, 0, 0, 1, 2, 3]) for _ in range(900)]
    docs = docs_of([(i, prose(i, k)) for i, k in enumerate(kinds)])
    labels = spark.createDataFrame([(i, int(k == 0), 0) for i, k in enumerate(kinds) if i % 5], LABELS)
    return docs, labels, kinds


def test_held_out_labels(corpus):
    docs, labels, kinds = corpus
    rows = quality.judge(docs, labels).collect()
    assert len(rows) == 900 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.predicted == (kinds[r.doc_id] == 0) for r in out]) > 0.97


def test_only_texts_and_open_labels_count(spark, corpus):
    docs, labels, _ = corpus
    plain = {r.doc_id: (r.score, r.predicted) for r in quality.judge(docs, labels).collect()}
    # other labels of held-out rows, other sources, another order of rows
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2 THEN 1 - quality ELSE quality END AS quality", "1 AS toxic")
    other = docs.selectExpr("doc_id", "text", "'zz' AS lang", "NULL AS source", "'x' AS v", "1 AS score", "2 AS id", "3 AS y").repartition(7)
    again = {r.doc_id: (r.score, r.predicted) for r in quality.judge(other, turned.repartition(5)).collect()}
    assert again == plain


def test_awkward_rows(spark, awkward):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 0, 1), (None, 1, 0), (5, None, 0), (6, 7, 0), (99, 1, 1)], LABELS)
    rows = quality.judge(awkward, labels).collect()
    assert len(rows) == 13 and all(r.score is not None and 0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    none = quality.judge(awkward, labels.where("doc_id = 99")).collect()
    assert {(r.score, r.predicted) for r in none} == {(0.5, 0)}
    assert quality.judge(awkward.limit(0), labels).collect() == []
    assert quality.judge(awkward, labels.limit(0)).count() == 13


def test_keep_good_keeps_columns(corpus):
    docs, labels, kinds = corpus
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {r.doc_id for r in quality.judge(docs, labels).where("predicted = 1").collect()}


def test_sums_equal_the_sample_in_one_place(corpus):
    docs, labels, _ = corpus
    rows = quality.sample(docs, labels, "doc_id", "text", "quality").collect()
    x, y = np.array([r.v for r in rows if not r.calibrates]), np.array([r.y for r in rows if not r.calibrates])
    model = quality.fit(docs, labels)
    z = model.features(x)
    assert np.allclose(model.mean, x.mean(0)) and np.allclose(model.scale[model.scale < 4096], x.std(0)[model.scale < 4096])
    plain = np.linalg.solve(z.T @ z + np.diag([quality.RIDGE * len(x) * 4096**2] * quality.FEATURES + [0]), z.T @ y)
    assert np.allclose(model.weights, plain, atol=1e-9)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.integers(0, 9)), min_size=1, max_size=12))
def test_pooling(found):
    n = np.array([a for a, _ in found])
    hits = np.array([min(a, b) for a, b in found])
    at = np.arange(len(n))
    places, shares = quality.pooled(at, n, hits)
    assert (np.diff(shares) > 0).all() and (np.diff(places) > 0).all()
    # the weighted least squares fit that never falls: max over starts of the min over ends of the mean
    best = [max(min(hits[a : b + 1].sum() / n[a : b + 1].sum() for b in range(i, len(n))) for a in range(i + 1)) for i in range(len(n))]
    assert np.allclose(sorted(set(np.round(best, 9))), np.round(shares, 9))


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=60))
def test_statistics_of_any_text(text):
    found = quality.statistics(text)
    assert found.shape == (len(quality.NAMES),) and (found >= 0).all() and (found < 32 * 4096).all()


def test_blocks_do_not_show(monkeypatch):
    text = prose(1, 0) + "\n" + prose(2, 3) + " 𝔘😀 é"
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert (quality.statistics(text) == whole).all()
    assert (quality.statistics(None) == 0).all() and (quality.statistics("") == 0).all()
