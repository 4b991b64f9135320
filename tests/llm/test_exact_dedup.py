import hashlib
import re
from collections import defaultdict

from cellmart.llm.exact_dedup import decide, drop_copies


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[plain(text)].append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = min((i for i in ids if i is not None), default=None)
        digest = hashlib.sha256(text.encode()).hexdigest()
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen = seen or kept
            out.append((i, keep, len(ids), kept, digest))
    return sorted(out, key=repr)


def found(df):
    rows = decide(df).collect()
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in rows), key=repr)


def test_frequent_and_rare_groups_equal_brute_force(docs_of):
    rows = [(i, "hot  text" if i % 3 == 0 else f"text {i % 50}" if i % 3 == 1 else f"own {i}") for i in range(900)]
    df = docs_of(rows, 7)
    for support in (1 / 4, 1 / 256, 1 / 2000):
        got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in decide(df, support=support).collect()), key=repr)
        assert got == brute(rows)


def test_nulls_blanks_and_repeated_rows(awkward):
    rows = [(r.doc_id, r.text) for r in awkward.collect()]
    assert found(awkward) == brute(rows)
    assert found(awkward.limit(0)) == []


def test_kept_rows_keep_their_columns(awkward):
    kept = drop_copies(awkward)
    assert kept.columns == awkward.columns
    rows = kept.collect()
    texts = [plain(r.text) for r in rows]
    assert len(texts) == len(set(texts)) == len({plain(r.text) for r in awkward.collect()})
    assert sorted(str(r.doc_id) for r in rows) == ["1", "3", "5", "6", "8"]
    assert drop_copies(awkward.limit(0)).count() == 0


def test_only_dataframe_functions(docs_of, plan):
    text = plan(drop_copies(docs_of([(i, f"t{i % 9}") for i in range(50)])))
    assert not any(x in text for x in ("PythonUDF", "MapInArrow", "MapInPandas", "FlatMapGroups", "ArrowEvalPython"))
