"""The pipeline's stages on given documents, each against what a plain reading of its input gives."""

import re
from collections import Counter, defaultdict

import corpus_pipeline
from test_minhash import similarity
from test_simhash import slow_components

from cellmart.llm import langid, packing


def test_stages_chain(spark, docs_of, words, tmp_path):
    rows = []
    for i in range(60):
        text = " ".join(words(i % 45, 20 + i % 45))
        rows.append((i, text if i < 45 else text.replace(" ", "  "), "en" if i % 2 else "de", f"src{i % 3}"))
    # near copies: one word of 50 and of 100 is another
    rows += [(80 + i, " ".join([*words(30 + i, 60 + 40 * i)[:-1], "other"]), "en", "src0") for i in range(2)]
    rows += [(90 + i, " ".join(words(30 + i, 60 + 40 * i)), "en", "src2") for i in range(2)]
    rows += [(70, "12 34 !!", "en", "src0"), (71, None, None, None), (72, "", "en", "src1")]
    docs = docs_of(rows)
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "exact_dedup", "near_dedup", "source_mix", "packing"]
    frames = [docs]
    for name in list(stages)[:-1]:
        out = stages[name](spark, frames[-1], str(tmp_path))
        assert out.schema == docs.schema
        frames.append(spark.createDataFrame(out.collect(), docs.schema))
    given, spoken, exact, near, mixed = ([tuple(r) for r in f.collect()] for f in frames)
    assert sorted(spoken) == sorted(r for r in given if langid.has_letter(r[1]))
    plain = {}
    for r in sorted(spoken):
        plain.setdefault(re.sub(r"\s+", " ", r[1]), r)
    assert sorted(exact) == sorted(plain.values())
    texts = {r[0]: r[1] for r in exact}
    named = slow_components(sorted(texts), lambda a, b: similarity(texts[a], texts[b]) >= 0.8)
    assert sorted(near) == sorted(r for r in exact if named[r[0]] == r[0]) and len(near) < len(exact)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in near:
        sizes[r[3]] += len(r[1].split())
    for r in mixed:
        taken[r[3]] += len(r[1].split())
    assert set(mixed) <= set(near) and max(Counter(mixed).values()) <= 3
    total = sum(sizes.values())
    assert 0.8 * total < sum(taken.values()) <= total and taken["src0"] > taken["src1"] > taken["src2"]
    packed = stages["packing"](spark, frames[-1], str(tmp_path)).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(r[0] for r in mixed)
    used = defaultdict(int)
    for r in packed:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= packing.CAPACITY


def test_registered_run(spark):
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and len(entry.queries()) > 10
    out = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    assert out.count() > 0
