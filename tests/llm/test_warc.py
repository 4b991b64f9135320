import hashlib
import re

import pytest

from cellmart.llm import warc

SCHEMA = "page_id long, url string, html string, record string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "extra") for r in rows], SCHEMA).repartition(4)


def brute(rows):
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        same = [p for p, _, h in rows if (h or "") == (html or "") and p is not None]
        first = min(same) if len(body) >= 100 and same else page
        again = page != first
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", first if again else None))
    return sorted(out, key=repr)


def found(spark, rows, **more):
    return sorted((tuple(r) for r in warc.archive(pages(spark, rows), **more).collect()), key=repr)


ROWS = [
    (0, "http://a/", "short"),
    (1, "http://a/1", "short"),
    (2, None, None),
    (3, "http://b\r\n/", ""),
    (4, "u", "x" * 99),
    (5, "u", "x" * 99),
    (6, "u", "é" * 50),
    (7, "u", "é" * 50),
    (9, "u", "long äöü 漢字 " * 40_000),
    (8, "u", "long äöü 漢字 " * 40_000),
    (10, "u", "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nafter" * 5 + "WARC/1.1\r\nWARC/1.1\r\n"),
    (11, "u", "\r\n0\r\n\r\n" * 100),
    *[(i, f"u{i}", "hot page " * 30) for i in range(20, 60, 2)],
]


@pytest.mark.parametrize("segment_bytes", [warc.SEGMENT_BYTES, 1000, 130])
def test_pages_come_back(spark, segment_bytes):
    rows = ROWS if segment_bytes > 500 else [r for r in ROWS if r[0] not in (8, 9)]
    assert found(spark, rows, segment_bytes=segment_bytes) == brute(rows)


def test_repeated_pages_and_null_ids(spark):
    page = "the same page " * 20
    got = found(spark, [(1, "a", page), (1, "a", page), (2, "b", page), (None, "c", page)])
    assert sorted(r[3] for r in got) == ["response", "revisit", "revisit", "revisit"]
    assert all(r[4] == 1 for r in got if r[3] == "revisit") and {r[1] for r in got} == {len(page)}
    got = found(spark, [(None, "a", page), (None, "b", page)])
    assert sorted(r[3] for r in got) == ["response", "revisit"]
    assert found(spark, []) == []


def test_files_are_archives(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archive(pages(spark, ROWS[:9]).coalesce(1), path, segment_bytes=1 << 16)
    (part,) = (tmp_path / "warc").glob("part-*")
    raw, at, kinds = part.read_bytes(), 0, []
    while at < len(raw):
        head = raw[at:].split(b"\r\n\r\n", 1)[0]
        assert head.startswith(b"WARC/1.1\r\n")
        size = int(re.search(rb"\r\nContent-Length: (\d+)", head)[1])
        kinds.append(re.search(rb"\r\nWARC-Type: (\w+)", head)[1])
        at += len(head) + 4 + size
        assert raw[at : at + 4] == b"\r\n\r\n"
        at += 4
    assert kinds.count(b"continuation") >= 8 and kinds.count(b"revisit") == 1


def test_small_splits_cut_no_record(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archive(pages(spark, ROWS).coalesce(1), path, segment_bytes=3000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    try:
        assert sorted((tuple(r) for r in warc.read_archive(spark, path).collect()), key=repr) == brute(ROWS)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_missing_and_damaged_segments_are_noticed(spark, tmp_path):
    path = str(tmp_path / "warc")
    warc.write_archive(pages(spark, ROWS), path, segment_bytes=5000)
    records = warc.read_records(spark, path)
    for lost in ("segment = 2", "total is not null"):
        with pytest.raises(Exception, match="missing"):
            warc.payloads(records.where(f"not coalesce({lost}, false)")).collect()


@pytest.mark.parametrize("text", ["", "a", "é" * 5000, "WARC/1.1\r\n" * 3, "x" * 50_000])
def test_framing(text):
    framed = warc.chunked(text, 100)
    assert warc.unchunked(framed.encode()) == text.encode() and warc.VERSION not in framed
    with pytest.raises(ValueError):
        warc.unchunked(framed.encode()[:-6])
    assert warc.unchunked(b"3;name=x\r\nabc\r\n0\r\nTrailer: y\r\n\r\n") == b"abc"


def test_framing_makes_no_first_line(spark):
    line = warc.VERSION.strip()
    step = warc.CHUNK_BYTES // 4
    texts = [line, f"page {line}", "x" * (step - len(line)) + line + "y" * 50, f"{line}{warc.VERSION}{line}", "z" * 40 + line * 30]
    for text in texts:
        assert warc.VERSION not in warc.chunked(text) and warc.unchunked(warc.chunked(text).encode()).decode() == text
    for most in range(9, 90):
        parts = warc._segments(texts[-1] + "end", most)
        assert "".join(parts) == texts[-1] + "end" and not any(p.endswith(line) for p in parts) and max(map(len, parts)) <= most
    rows = [(i, f"http://a/{line}", text) for i, text in enumerate(texts)]
    assert found(spark, rows, segment_bytes=130) == brute(rows)
