from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cellmart.llm import mixing


def slow_targets(sizes, weights=(5, 2, 1), most=3):
    names = sorted(sizes, key=lambda s: (s is None, "" if s is None else s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(most * sizes[s] for s in capped)
        shares = sum(weight[s] for s in names if s not in capped)
        target = {s: most * sizes[s] if s in capped else left * weight[s] / shares for s in names}
        over = {s for s in names if target[s] > most * sizes[s] and s not in capped}
        if not over:
            return target
        capped |= over


def rows_for(words, sizes):
    rows, i = [], 0
    for source, (number, length) in sizes.items():
        for k in range(number):
            rows.append((i, " ".join(words(i, 1 + (length * (k + 1)) % (2 * length))), "en", source))
            i += 1
    return rows


CASES = [
    {"a": (40, 30), "b": (40, 30), "c": (200, 30)},
    {"a": (3, 10), "b": (2, 5), "c": (400, 40), "d": (1, 1), None: (30, 9)},
    {"a": (300, 20)},
]


@pytest.mark.parametrize("case", CASES)
def test_targets_and_what_is_taken(docs_of, words, case):
    rows = rows_for(words, case)
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(text.split())
    expected = slow_targets(sizes)
    got = mixing.mix(docs_of(rows)).collect()
    assert sorted(r.doc_id for r in got) == [r[0] for r in rows]
    taken = defaultdict(int)
    for r in got:
        assert r.size == len(rows[r.doc_id][1].split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(expected[r.source]) and 0 <= r.copies <= 3 and len(r.positions) == r.copies
        assert all(0 <= p <= 1 for p in r.positions) and list(r.positions) == sorted(r.positions)
        taken[r.source] += r.copies * r.size
    for source, target in expected.items():
        # of the documents that the last pass left out, none would have fitted
        passes = int(target // sizes[source])
        out = [r.size for r in got if r.source == source and r.copies == passes]
        assert target - min(out, default=1) - 1 < taken[source] <= target + 1e-6


def test_many_bins_and_reruns_agree(docs_of, words, monkeypatch):
    rows = rows_for(words, CASES[0])
    whole = mixing.mix(docs_of(rows, 2)).collect()
    again = mixing.mix(docs_of(rows, 9)).collect()
    key = lambda r: (r.doc_id, r.copies, tuple(r.positions))
    assert sorted(map(key, whole)) == sorted(map(key, again))
    monkeypatch.setattr(mixing, "BIN_ROWS", 7)
    small = mixing.mix(docs_of(rows)).collect()
    taken = defaultdict(int)
    for r in small:
        taken[r.source, r.target] += r.copies * r.size
    assert all(0 <= target - words_ < 31 for (_, target), words_ in taken.items())


def test_copies_of_a_source_follow_each_other_without_gaps(docs_of, words, monkeypatch):
    monkeypatch.setattr(mixing, "BIN_ROWS", 16)
    rows = rows_for(words, {"a": (50, 20), "b": (400, 30)})
    flat = [((0.0, 1.0), (1.0, 1.0))] * 3
    spans = defaultdict(list)
    for r in mixing.mix(docs_of(rows), schedules=flat).collect():
        spans[r.source, r.target] += [(p * r.target, r.size) for p in r.positions]
    for (_, target), found in spans.items():
        at = 0
        for start, size in sorted(found):
            assert start == pytest.approx(at, abs=1e-6)
            at += size


@pytest.mark.parametrize("knots", [((0.0, 1.5), (1.0, 0.5)), ((0.0, 0.0), (0.3, 2.0), (0.6, 0.0), (1.0, 1.0)), ((0.0, 1.0), (1.0, 1.0))])
def test_time_inverts_the_integrated_schedule(spark, knots):
    def integral(t):
        done = 0.0
        for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False):
            u = min(max(t, t0), t1) - t0
            done += w0 * u + (w1 - w0) / (t1 - t0) * u * u / 2
        return done

    rows = spark.range(0, 101).select((F.col("id") / 100).alias("x"))
    for r in rows.select("x", mixing.time_of(F.col("x"), knots).alias("t")).collect():
        assert integral(r.t) == pytest.approx(r.x * integral(1.0), abs=1e-9)


def test_training_order(docs_of, words):
    rows = rows_for(words, CASES[0])
    docs = docs_of(rows)
    mixed = mixing.mix(docs)
    out = mixing.training_order(docs, mixed)
    assert out.columns == docs.columns
    got = [r.doc_id for r in out.collect()]
    expected = sorted((p, r.doc_id) for r in mixed.collect() for p in r.positions)
    at = defaultdict(list)
    for p, i in expected:
        at[i].append(p)
    order = [at[i].pop(0) for i in got]
    assert order == sorted(order) and len(got) == len(expected)


def test_awkward_rows(awkward):
    got = mixing.mix(awkward).collect()
    assert len(got) == awkward.count()
    assert {r.size for r in got if r.doc_id in (3, 4, 5)} == {0}
    out = mixing.training_order(awkward, mixing.mix(awkward))
    assert out.columns == awkward.columns
    assert out.count() == sum(r.copies for r in got)
    assert mixing.mix(awkward.limit(0)).count() == 0
    assert mixing.training_order(awkward.limit(0), mixing.mix(awkward.limit(0))).count() == 0


@pytest.mark.parametrize("text,n", [(None, 0), ("", 0), (" \t\n", 0), ("a", 1), (" a  b\x0bc\x0cd\re\n", 5), ("a b", 1)])
def test_word_count(spark, text, n):
    assert spark.createDataFrame([(text,)], "t string").select(mixing.word_count(F.col("t"))).first()[0] == n
