"""Line dedup over content-defined chunks of lines."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, fresh, matched, pieces_of, stored, text_hash

# lines whose hashes decide whether a chunk ends
WINDOW = 2
# a chunk ends after one line in so many
MEAN_LINES = 4
MIN_LINES = 2
MAX_LINES = 64
_MASK = (1 << 64) - 1
_FACTOR = 0x9E3779B97F4A7C15


def chunks_of(text: str, window: int = WINDOW, mean: int = MEAN_LINES) -> list[tuple[int, int, int, int]]:
    """Start and end (code points, the last line feed excluded), lines and digest of each chunk of a text.

    A rolling hash over the last ``window`` line hashes ends a chunk, so the same lines are cut alike wherever
    they stand; only a chunk's first lines wait until the window lies inside it. Chunks
    are cut at ``MAX_LINES`` at the latest.
    """
    found, first, start, at, rolled = [], 0, 0, 0, 0
    out = pow(_FACTOR, window, 1 << 64)
    hashes: list[int] = []
    lines = text.split("\n")
    for i, line in enumerate(lines):
        hashes.append(xxhash.xxh64_intdigest(line.encode("utf-8", "surrogatepass")) | 1)
        rolled = (rolled * _FACTOR + hashes[i]) & _MASK
        if i >= window:
            rolled = (rolled - hashes[i - window] * out) & _MASK
        at += len(line) + 1
        size = i + 1 - first
        ends = i + 1 >= window and ((rolled * _FACTOR & _MASK) >> 40) % mean == 0
        if i + 1 == len(lines) or size >= MAX_LINES or (ends and size >= MIN_LINES):
            body = text[start : at - 1].encode("utf-8", "surrogatepass")
            found.append((start, at - 1, size, xxhash.xxh64_intdigest(body)))
            first, start = i + 1, at
    return found


def runs_of(text: str) -> list[tuple[int, int, int, int]]:
    """Start, end, lines and digest, as in :func:`chunks_of`, of every ``MIN_LINES`` lines in a row; they overlap."""
    found, ends, at = [], [], 0
    starts: list[int] = []
    for line in text.split("\n"):
        starts.append(at)
        ends.append(at + len(line))
        at += len(line) + 1
    for start, end in zip(starts, ends[MIN_LINES - 1 :], strict=False):
        body = text[start:end].encode("utf-8", "surrogatepass")
        found.append((start, end, MIN_LINES, xxhash.xxh64_intdigest(body)))
    return found


def chunks(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", cut: Callable[[str], list[tuple[int, int, int, int]]] | None = None
) -> DataFrame:
    """``doc_id, mark, chunk, start, end, lines, digest`` per chunk of two lines or more, ``chunk`` being the number of its first line;
    ``cut`` is :func:`chunks_of` unless given."""
    cut = cut or chunks_of
    given = docs.select(col(doc_id).alias("doc_id"), text_hash(doc_id, text).alias("mark"), col(text).alias("text"))
    fields = [given.schema["doc_id"], given.schema["mark"]]
    schema = T.StructType([*fields, *T.StructType.fromDDL("chunk int, start long, end long, lines int, digest long").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found = [], []
            for i, value in enumerate(batch.column(2)):
                if value.is_valid:
                    whole, line, at = value.as_py(), 0, 0
                    for start, end, lines, digest in cut(whole):
                        line, at = line + whole.count("\n", at, start), start
                        if lines >= MIN_LINES:
                            rows.append(i)
                            found.append((line, start, end, lines, digest - (1 << 64) if digest >> 63 else digest))
            own = pa.RecordBatch.from_arrays(batch.columns[:2], ["doc_id", "mark"]).take(pa.array(rows, pa.int64()))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            values = [pa.array([x[j] for x in found], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*own.columns, *values], schema.names)

    return given.mapInArrow(run, schema)


def _outside(found: DataFrame, spans: DataFrame) -> DataFrame:
    """Rows of ``found`` that do not lie within one of their text's ``spans``."""
    listed = spans.groupBy(F.col("doc_id").alias("_id"), F.col("mark").alias("_of")).agg(F.collect_list(F.struct("start", "end")).alias("_spans"))
    joined = matched(found, stored(listed, "covered"), [("doc_id", "_id"), ("mark", "_of")], "left")
    inside = F.exists("_spans", lambda x: (x["start"] <= F.col("start")) & (x["end"] >= F.col("end")))
    return joined.where(~F.coalesce(inside, F.lit(False))).select(*found.columns)


def repeated_chunks(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    cut: Callable[[str], list[tuple[int, int, int, int]]] | None = None,
    known: DataFrame | None = None,
) -> DataFrame:
    """Chunks to remove: ``doc_id, mark, chunk, start, end, lines``; those within the spans ``known``, which go anyway, are passed over.

    Digests that occur twice anywhere name the candidates; only their text is fetched, and rows are grouped by digest
    and text, which compares the bytes. Of equal chunks the one of the smallest id stays (no id last; then the first in the
    text); counts and minima are summed in the scan tasks.
    """
    # repeated rows are one document
    found = stored(chunks(docs, doc_id, text, cut).distinct(), "chunks")
    twice = found.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    candidates = found.join(twice, "digest", "left_semi")
    if known is not None:
        candidates = _outside(candidates, known)
    cuts, key, mark, own = (fresh(docs, n) for n in ("_cuts", "_chunk_id", "_chunk_mark", "_mark"))
    listed = candidates.groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark)).agg(
        F.collect_list(F.struct("chunk", "start", "end", "lines", "digest")).alias(cuts)
    )
    texts = docs.select(col(doc_id), col(text)).withColumn(own, text_hash(doc_id, text))
    joined = matched(texts, stored(listed, "candidates"), [(doc_id, key), (own, mark)], "inner")
    bodies = F.arrays_zip(col(cuts).alias("c"), pieces_of(col(text), col(cuts)).alias("body"))
    each = joined.select(col(key).alias("doc_id"), col(mark).alias("mark"), F.inline(bodies))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark", F.col("c.chunk").alias("chunk")).alias("rank")
    each = stored(each.select(rank, "c.*", "body").distinct(), "bodies")
    winners = each.groupBy("digest", "body").agg(F.min("rank").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # stored, so that the join is one of two tables and Spark splits a chunk that very many documents share
    copies = each.join(stored(winners.drop("n"), "winners"), ["digest", "body"]).where("rank <> first")
    return copies.select("rank.doc_id", "rank.mark", "chunk", "start", "end", "lines")


def grown_chunks(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As :func:`repeated_chunks`, with every repeated chunk grown to both sides, line by line: all passages of ``MIN_LINES``
    lines or more that an earlier place holds go at full length.

    Chunks between content-defined boundaries are compared first and take most of what repeats. A passage also reaches
    into the chunks at its edges, or lies within one; so every two lines in a row that no removed chunk
    covers are compared by digest and bytes as well, and what overlaps or adjoins a chunk becomes part of its span. The first occurrence of each
    two lines stays: it is never in a removed chunk, since that has an earlier copy.
    """
    whole = stored(repeated_chunks(docs, doc_id, text), "whole")
    rest = repeated_chunks(docs, doc_id, text, runs_of, known=whole)
    every = whole.unionByName(rest)
    order = Window.partitionBy("doc_id", "mark").orderBy("chunk", "lines")
    last = F.max(F.col("chunk") + F.col("lines")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = (last.isNull() | (F.col("chunk") > last)).cast("int")
    spans = every.withColumn("opens", opens).withColumn("run", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    lines = (F.max(F.col("chunk") + F.col("lines")) - F.min("chunk")).cast("int")
    spans = spans.groupBy("doc_id", "mark", "run").agg(
        F.min("chunk").alias("chunk"), F.min("start").alias("start"), F.max("end").alias("end"), lines.alias("lines")
    )
    return spans.drop("run")


def drop_repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", repeated: Callable[..., DataFrame] = repeated_chunks
) -> DataFrame:
    """``docs`` with repeated chunks (or what ``repeated`` names) of lines cut out of the texts, and the columns ``lines`` and ``removed_lines`` added.

    ``lines`` counts the original lines. A chunk goes with the line feed that ends it. What is removed anywhere is
    kept once, in the earliest place. NULL texts stay NULL (no lines); an empty text is one line; rows that
    repeat id and text are one document and are treated alike. An empty table gives an empty result. Other columns stay as they
    are; a name that is taken gets an underscore.
    """
    gone = repeated(docs, doc_id, text)
    key, mark, cuts, own, counted, removed = (
        fresh(docs, n) for n in ("_gone_id", "_gone_mark", "_cuts", "_mark", "lines", "removed_lines")
    )
    listed = gone.groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts), F.sum("lines").alias(removed)
    )
    joined = matched(docs.withColumn(own, text_hash(doc_id, text)), stored(listed, "gone"), [(doc_id, key), (own, mark)], "left")
    # what lies between the removed chunks, each with the line feed after it
    n, length = F.size(col(cuts)), F.length(col(text)).cast("long")
    between = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.struct(
            F.when(i == 0, 0).otherwise(F.get(col(cuts), i - 1)["end"] + 1).cast("long").alias("start"),
            F.when(i == n, length).otherwise(F.get(col(cuts), i)["start"]).alias("end"),
        ),
    )
    # only texts that lose something go to Python
    some = F.when(col(cuts).isNotNull(), col(text))
    step = F.array_join(pieces_of(some, F.when(col(cuts).isNotNull(), between)), "")
    # a text that loses its last chunk loses the line feed before it
    ended = F.element_at(col(cuts), -1)["end"] == F.length(col(text))
    out = F.when(col(cuts).isNull(), col(text)).when(ended, F.regexp_replace(step, "\n$", "")).otherwise(step)
    lines = F.length(col(text)) - F.length(F.replace(col(text), F.lit("\n"), F.lit(""))) + 1
    others = [out.alias(c) if c == text else col(c) for c in docs.columns]
    return joined.select(
        *others, F.coalesce(lines, F.lit(0)).cast("long").alias(counted), F.coalesce(col(removed), F.lit(0)).cast("long").alias(removed)
    )
