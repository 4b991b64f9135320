"""WARC archives: writing pages as records, reading records back, and joining segmented ones."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellmart.llm.common import col, matched, stored
from cellmart.session import scratch_path

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
_LINE = VERSION.strip()
# payloads from this size on are written once
MIN_SHARED = 100
SEGMENT_BYTES = 64 * 1024
CHUNK_BYTES = 16 * 1024
RECORDS_PER_FILE = 50_000
DATE = "2000-01-01T00:00:00Z"
_FACTS = "page_id long, record_id string, record_type string, refers_record string"
_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


# ---- framing --------------------------------------------------------------


def chunked(payload: str, most: int = CHUNK_BYTES) -> str:
    """Chunked transfer framing. Chunks end between characters, and inside anything that looks like a record's first line,
    or would with the line feed that ends the chunk."""
    parts = []
    step = max(most // 4, 1)
    for piece in payload.split(VERSION) if VERSION in payload else [payload]:
        parts += [piece[i : i + step] for i in range(0, len(piece), step)]
        parts += [VERSION[:4], VERSION[4:]]
    parts = [x for p in parts[:-2] for x in ([p[:-4], p[-4:]] if p.endswith(_LINE) else [p])]
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in parts) + "0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload inside chunked transfer framing; extensions and trailers are passed over."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        if not size:
            return b"".join(parts)
        at = line + 2
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response, its transfer framing undone."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = head.lower().split(b"\r\n")[1:]
    if any(f.startswith(b"transfer-encoding:") and b"chunked" in f for f in fields):
        return unchunked(body)
    return body


def _segments(block: str, most: int) -> list[str]:
    """Parts of a block of at most ``most`` bytes, cut between characters and inside no record's first line."""
    raw, parts, at = block.encode(), [], 0
    while at < len(raw):
        end = min(at + most, len(raw))
        while end < len(raw) and end > at + 1 and (raw[end] & 0xC0) == 0x80:
            end -= 1
        if raw[at:end].endswith(_LINE.encode()):
            end -= 1
        parts.append(raw[at:end].decode())
        at = end
    return parts or [""]


def _record(block: str, fields: list[tuple[str, object]]) -> str:
    named = "".join(f"{name}: {value}\r\n" for name, value in fields if value is not None)
    return f"{VERSION}{named}Content-Length: {len(block.encode())}{END}{block}"


def _uri(url: str | None) -> str | None:
    """A header value on one line; its last character is escaped if the line would end like a record's first one."""
    line = None if url is None else " ".join(url.split())
    return f"{line[:-1]}%{ord(line[-1]):x}" if line and line.endswith(_LINE) else line


def _urn(*parts: object) -> str:
    x = hashlib.sha256("|".join(map(str, parts)).encode()).hexdigest()
    return f"<urn:uuid:{x[:8]}-{x[8:12]}-{x[12:16]}-{x[16:20]}-{x[20:32]}>"


# ---- writing --------------------------------------------------------------


def _decided(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, digest, keep, number``: the page whose record holds the payload, and for repeats of that page their number."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"), F.sha2(payload, 256).alias("digest")
    )
    shared = rows.where(F.octet_length("html") >= MIN_SHARED).groupBy("digest").agg(
        F.min("page_id").alias("keep"), F.count(F.lit(1)).alias("n"), F.countDistinct("page_id").alias("ids")
    )
    groups = stored(shared.where("n > 1"), "shared").select(F.col("digest").alias("same"), "keep", (F.col("n") > F.col("ids")).alias("twins"))
    joined = matched(rows, groups, [("digest", "same")], "left")
    joined = joined.withColumn("shared", F.col("same").isNotNull()).drop("same")
    once = joined.where(~F.coalesce("twins", F.lit(False))).withColumn("number", F.lit(1))
    # pages that occur twice with the same payload: the first record of the smallest id is the response
    order = Window.partitionBy("digest", "page_id").orderBy("url")
    twice = joined.where("twins").withColumn("number", F.row_number().over(order))
    return once.unionByName(twice)


def write_archive(pages: DataFrame, path: str, segment_bytes: int = SEGMENT_BYTES, records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes a record per row of ``pages(page_id, url, html)`` to WARC files below ``path``.

    The payload is the html in UTF-8 (NULL: empty), in chunked transfer framing. Of equal payloads of at least
    ``MIN_SHARED`` bytes the page with the smallest id gets a response record and the others a revisit record that refers to it;
    a payload is never collected, only its digest is grouped. A NULL id comes last; if
    all ids are NULL, one of them is the response. Of rows that repeat the smallest id, one is. Blocks over
    ``segment_bytes`` become a first record and continuation records. An empty table gives an archive without records.
    """
    rows = _decided(pages.select("page_id", "url", "html"))
    first = F.col("page_id").eqNullSafe(F.col("keep")) & (F.col("number") == 1)
    revisit = (F.col("shared") & ~first).alias("revisit")
    given = rows.select("page_id", "url", "html", "digest", "keep", revisit, "shared", F.monotonically_increasing_id().alias("row"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in range(batch.num_rows):
                page, url, html, digest, keep, again, shared, row = (c[r].as_py() for c in batch.columns)
                own = _urn(page, digest, row) if again or not shared else _urn(keep, digest)
                fields: list[tuple[str, object]] = [
                    ("WARC-Type", "revisit" if again else "response"),
                    ("WARC-Record-ID", own),
                    ("WARC-Date", DATE),
                    ("WARC-Target-URI", _uri(url)),
                    ("WARC-Payload-Digest", f"sha256:{digest}"),
                    ("Content-Type", "application/http; msgtype=response"),
                    ("Page-ID", page),
                ]
                if again:
                    refers = [("WARC-Refers-To", _urn(keep, digest)), ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")]
                    out.append(_record(f"{_HEAD}\r\n", fields + refers))
                    continue
                block = f"{_HEAD}Transfer-Encoding: chunked\r\n\r\n{chunked(html)}"
                parts = _segments(block, segment_bytes)
                if len(parts) == 1:
                    out.append(_record(block, fields))
                    continue
                out.append(_record(parts[0], [*fields, ("WARC-Segment-Number", 1)]))
                for number, part in enumerate(parts[1:], 2):
                    more: list[tuple[str, object]] = [
                        ("WARC-Type", "continuation"),
                        ("WARC-Record-ID", _urn(own, number)),
                        ("WARC-Date", DATE),
                        ("WARC-Segment-Origin-ID", own),
                        ("WARC-Segment-Number", number),
                    ]
                    if number == len(parts):
                        more.append(("WARC-Segment-Total-Length", len(block.encode())))
                    out.append(_record(part, more))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.string())], ["record"])

    records = given.mapInArrow(run, "record string")
    records.write.option("lineSep", END).option("maxRecordsPerFile", records_per_file).text(path)


# ---- reading --------------------------------------------------------------


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``record_id, record_type, page_id, digest, refers_to, origin, segment, total, block`` per record below ``path``.

    Files are split anywhere and cut at records' first lines. A record whose block is shorter than its
    ``Content-Length`` stops the job: it was cut off, or holds such a line itself.
    """
    raw = spark.read.option("lineSep", VERSION).text(path).select(F.col("value").cast("binary").alias("value"))
    out = "record_id string, record_type string, page_id long, digest string, refers_to string, origin string, segment int, total long, block binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.strip().split(" ")[0] for x in out.split(",")]
        types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
        for batch in batches:
            rows = []
            for value in batch.column(0):
                head, gap, rest = value.as_py().partition(b"\r\n\r\n")
                if not gap:
                    continue  # before the first record
                fields = {}
                for line in head.decode("utf-8", "replace").split("\r\n"):
                    name, _, text = line.partition(":")
                    fields[name.strip().lower()] = text.strip()
                size = int(fields["content-length"])
                if len(rest) < size:
                    raise ValueError(f"record {fields.get('warc-record-id')} has {len(rest)} of {size} bytes")
                number = {k: int(fields[k]) if k in fields else None for k in ("page-id", "warc-segment-number", "warc-segment-total-length")}
                rows.append((
                    fields.get("warc-record-id"), fields.get("warc-type"), number["page-id"], fields.get("warc-payload-digest"),
                    fields.get("warc-refers-to"), fields.get("warc-segment-origin-id"), number["warc-segment-number"],
                    number["warc-segment-total-length"], rest[:size],
                ))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return raw.mapInArrow(run, out)


def payloads(records: DataFrame) -> DataFrame:
    """``record_id, record_type, page_id, refers_to, payload_bytes, payload_digest`` per response and revisit record.

    Continuation records are grouped by their origin and ordered by segment number; numbers must run from 1 and
    lengths add up to the total that the last one states. Only segmented records are shuffled, and a group is one payload.
    The transfer framing is undone and the payload checked against its digest; what does not agree stops the job.
    Revisits have the digest that their record states and no size.
    """
    part = F.struct("segment", "total", "block", "record_type", "page_id", "digest", "refers_to")
    cut = records.where("segment is not null").groupBy(F.coalesce("origin", "record_id").alias("record_id"))
    joined = cut.agg(F.sort_array(F.collect_list(part)).alias("parts")).select("record_id", "parts")
    whole = records.where("segment is null").select("record_id", F.array(part).alias("parts"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, value in zip(batch.column(0), batch.column(1), strict=True):
                name, parts = name.as_py(), value.as_py()
                first, block = parts[0], b"".join(p["block"] for p in parts)
                if first["segment"] is not None:
                    if [p["segment"] for p in parts] != list(range(1, len(parts) + 1)) or parts[-1]["total"] != len(block):
                        raise ValueError(f"segments of {name} are missing")
                digest = (first["digest"] or "").removeprefix("sha256:") or None
                if first["record_type"] == "revisit":
                    size = None
                else:
                    payload = payload_of(block)
                    size, found = len(payload), hashlib.sha256(payload).hexdigest()
                    if digest not in (None, found):
                        raise ValueError(f"the payload of {name} does not have its digest")
                    digest = found
                rows.append((name, first["record_type"], first["page_id"], first["refers_to"], size, digest))
            types = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
            names = ["record_id", "record_type", "page_id", "refers_to", "payload_bytes", "payload_digest"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    out = "record_id string, record_type string, page_id long, refers_to string, payload_bytes long, payload_digest string"
    return whole.unionByName(joined).mapInArrow(run, out)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` per page; revisits have the size and id of the response they refer to."""
    found = stored(payloads(read_records(spark, path)), "payloads")
    names = [F.col("record_id").alias("first"), F.col("page_id").alias("first_page"), F.col("payload_bytes").alias("first_bytes"), F.col("payload_digest").alias("first_digest")]
    asked = found.where("record_type = 'revisit'").select(F.col("refers_to").alias("record_id")).distinct()
    responses = stored(found.where("record_type = 'response'").join(asked, "record_id", "left_semi").select(*names), "responses")
    joined = matched(found, responses, [("refers_to", "first")], "left")
    right = (F.col("record_type") == "response") | (F.col("payload_digest") == F.col("first_digest"))
    checked = F.when(right, F.coalesce("payload_bytes", "first_bytes")).otherwise(
        F.raise_error(F.concat(F.lit("no response for "), F.col("record_id"))).cast("long")
    )
    return joined.select("page_id", checked.alias("payload_bytes"), "payload_digest", "record_type", F.col("first_page").alias("refers_to"))


def archive(pages: DataFrame, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Writes ``pages`` as an archive below the shared folder and reads it back, see :func:`write_archive` and :func:`read_archive`."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archive(pages, path, segment_bytes)
    return read_archive(pages.sparkSession, path)
