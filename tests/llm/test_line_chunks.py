import random
from collections import defaultdict

from cellmart.llm import line_chunks


def lines_of(seed, n):
    rng = random.Random(seed)
    return [f"line {rng.getrandbits(60)}" for _ in range(n)]


def brute(rows):
    """Texts without chunks that an earlier place holds, compared as strings."""
    seen, out = set(), {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        lines, stays = text.split("\n"), []
        for start, end, size, _ in line_chunks.chunks_of(text):
            body = text[start:end]
            assert body.split("\n") == lines[:size]
            lines = lines[size:]
            if size > 1 and body in seen:
                continue
            seen.add(body)
            stays.append(body)
        out[i] = "\n".join(stays)
        assert not lines
    return out


def test_repeated_blocks_go_and_the_first_stays(docs_of):
    shared = lines_of(0, 40)
    rows = []
    for i in range(80):
        own = lines_of(i + 1, 12)
        at = i % 13
        rows.append((i, "\n".join(own if i % 3 else [*own[:at], *shared, *own[at:]])))
    got = {r.doc_id: r for r in line_chunks.drop_repeated_lines(docs_of(rows)).collect()}
    assert {i: r.text for i, r in got.items()} == brute(rows)
    for i, text in rows:
        left = 0 if got[i].text == "" else got[i].text.count("\n") + 1
        assert got[i].lines == text.count("\n") + 1 and got[i].removed_lines == got[i].lines - left
        # nearly all of the shared block is found in spite of its place
        assert got[i].removed_lines >= (25 if i and i % 3 == 0 else 0) and (i % 3 == 0 or got[i].text == text)


def test_equal_digests_are_told_apart_by_their_bytes(docs_of, monkeypatch):
    real = line_chunks.chunks_of
    rows = [(i, "\n".join(lines_of(i % 4, 9))) for i in range(12)]
    expected = brute(rows)
    monkeypatch.setattr(line_chunks, "chunks_of", lambda text: [(a, b, n, 7) for a, b, n, _ in real(text)])
    got = {r.doc_id: r.text for r in line_chunks.drop_repeated_lines(docs_of(rows)).collect()}
    assert got == expected


def test_cuts_depend_on_content(docs_of):
    shared = lines_of(0, 400)
    whole = "\n".join(shared)
    cut = {whole[a:b] for a, b, _, _ in line_chunks.chunks_of(whole)}
    moved = "\n".join([*lines_of(9, 7), *shared])
    again = {moved[a:b] for a, b, _, _ in line_chunks.chunks_of(moved)}
    assert len(cut & again) >= 0.9 * len(cut)
    assert max(n for *_, n, _ in line_chunks.chunks_of("\n".join(["same"] * 1000))) <= line_chunks.MAX_LINES


def test_awkward_rows(awkward, docs_of):
    out = line_chunks.drop_repeated_lines(awkward)
    assert out.columns == [*awkward.columns, "lines", "removed_lines"]
    assert sorted(repr(r[:-2]) for r in out.collect()) == sorted(repr(tuple(r)) for r in awkward.collect())
    block = "\n".join(lines_of(3, 6))
    df = docs_of([(5, block), (5, block), (None, block), (6, f"{block}\n"), (7, "")])
    texts = defaultdict(list)
    for r in line_chunks.drop_repeated_lines(df).collect():
        texts[r.doc_id].append(r.text)
    assert texts[5] == [block, block] and texts[7] == [""] and len(texts[None][0]) < len(block)
    assert line_chunks.drop_repeated_lines(awkward.limit(0)).count() == 0
    clash = df.withColumnRenamed("n_chars", "lines")
    assert line_chunks.drop_repeated_lines(clash).columns[-2:] == ["lines_", "removed_lines"]


def test_chunks_come_first_and_grow(docs_of):
    """A long block is found as chunks; its edges and what surrounds them only by growing."""
    block = lines_of(1, 60)
    rows = [(i, "\n".join([*lines_of(50 + i, 5), *block[i : 60 - i], *lines_of(90 + i, 5)])) for i in range(6)]
    docs = docs_of(rows)
    whole = {r.doc_id: r.n for r in line_chunks.repeated_chunks(docs).groupBy("doc_id").agg({"lines": "sum"}).withColumnRenamed("sum(lines)", "n").collect()}
    grown = line_chunks.grown_chunks(docs).collect()
    assert sorted((r.doc_id, r.chunk, r.lines) for r in grown) == [(i, 5, 60 - 2 * i) for i in range(1, 6)]
    assert all(20 < whole[i] < 60 - 2 * i for i in range(1, 6))
    texts = dict(rows)
    for r in grown:
        assert texts[r.doc_id][r.start : r.end].split("\n") == block[r.doc_id : 60 - r.doc_id]


def test_every_repeated_passage_goes(docs_of):
    rng = random.Random(5)
    passages = [lines_of(100 + n, n) for n in (2, 3, 4, 40)]
    rows = []
    for i in range(60):
        own, at = lines_of(i + 1000, rng.randrange(9)), rng.randrange(9)
        rows.append((i, "\n".join([*own[:at], *passages[i % 4], *own[at:]])))
    rows.append((70, "\n".join(["a", "b", "c", "a", "b", "c", "a", "b"])))
    seen, expected = set(), {}
    for i, text in rows:
        lines, gone = text.split("\n"), set()
        for k, pair in enumerate(zip(lines, lines[1:], strict=False)):
            if pair in seen:
                gone |= {k, k + 1}
            seen.add(pair)
        expected[i] = ("\n".join(x for k, x in enumerate(lines) if k not in gone), len(gone))
    got = line_chunks.drop_repeated_lines(docs_of(rows), repeated=line_chunks.grown_chunks).collect()
    assert {r.doc_id: (r.text, r.removed_lines) for r in got} == expected
