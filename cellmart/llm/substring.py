"""Passages that repeat across documents: hashed pieces of lines, earliest kept, the rest as spans of the original."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, fresh, matched, stored, text_hash

MIN_WORDS = 50
# every so many words in a row hold the start of a unit
WINDOW = 16
# characters turned into word hashes at a time
BLOCK = 1 << 20
_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15 | 1, np.uint64))
_ODD = np.uint64(0xD6E8FEB86659FD93)
_LAST_ID = (1 << 63) - 1
# a digest with more than this share of all pairs of units meets its owner by broadcast, so there are fewer than 1 / HOT of them
HOT = 1 / 1024


def _lower() -> np.ndarray:
    """Lower case per code point below 65,536, where it is a single one; ASCII signs as 0."""
    table = np.array([ord(x) if len(x := chr(i).lower()) == 1 else i for i in range(1 << 16)], np.uint64)
    signs = [i for i in range(128) if not chr(i).isalnum()]
    table[signs] = 0
    return table


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(29))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of each run of ``values``, order counted."""
    at = np.arange(len(values)) - np.repeat(starts, np.diff(np.r_[starts, len(values)]))
    return _mix(np.add.reduceat(values * _POWERS[at & 1023], starts))


def words_of(text: str, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word, and whether it is the first of its line. Case and ASCII signs do not count."""
    hashes, starts, ends, firsts = [], [], [], []
    at, fresh_line = 0, True
    while at < len(text):
        stop = at + BLOCK
        # a block ends in white space, so that no word is cut
        while stop < len(text) and text[stop] not in " \t\n\v\f\r":
            stop += 1
        codes = np.frombuffer(text[at:stop].encode("utf-32-le", "surrogatepass"), "<u4")
        space = (codes == 32) | ((codes >= 9) & (codes <= 13))
        edge = np.diff(np.r_[True, space, True].astype(np.int8))
        first, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        line = np.r_[0, np.cumsum(codes == 10)]
        if len(first):
            inner = codes[~space]
            plain = np.where(inner < len(lower), lower[np.minimum(inner, len(lower) - 1)], inner.astype(np.uint64))
            hashes.append(_sums(plain, np.r_[0, np.cumsum(end - first)[:-1]]))
            starts.append(first + at)
            ends.append(end + at)
            of = line[first]
            firsts.append(np.r_[fresh_line or of[0] > 0, of[1:] != of[:-1]])
            fresh_line = bool(line[-1] > of[-1])
        else:
            fresh_line = fresh_line or bool(line[-1])
        at = stop
    if not hashes:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none, none.astype(bool)
    return tuple(np.concatenate(x) for x in (hashes, starts, ends, firsts))  # type: ignore[return-value]


def units_of(text: str, lower: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Digest, start, end and words of each unit of a text.

    Units start with lines, and at words that the content chooses: the one with the smallest hash (of it and the
    word before) among ``window`` in a row. A passage is cut alike wherever it is pasted, but for its edges.
    """
    hashes, starts, ends, firsts = words_of(text, lower)
    n = len(hashes)
    if not n:
        return hashes, starts, starts, starts
    cut = firsts.copy()
    cut[0] = True
    pair = _mix(hashes * np.uint64(3) + np.r_[np.uint64(0), hashes[:-1]])
    if n >= window:
        for at in range(0, n - window + 1, BLOCK):
            views = np.lib.stride_tricks.sliding_window_view(pair[at : at + BLOCK + window - 1], window)
            cut[at + np.arange(len(views)) + views.argmin(1)] = True
    firsts = np.flatnonzero(cut)
    after = np.r_[firsts[1:], n]
    return _sums(hashes, firsts), starts[firsts], ends[after - 1], after - firsts


def pairs_of(digest: np.ndarray, start: np.ndarray, end: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, ...]:
    """Digest, start, end and sizes of each two adjacent units."""
    both = _mix(digest[:-1] * np.uint64(5) + _mix(digest[1:]))
    return both, start[:-1], end[1:], words[:-1] + (words[1:] << 16)


def pairs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``rank, mark, unit, digest, start, end, sizes`` per pair of adjacent units of every text, ``unit`` being the first.

    ``rank`` is the id; rows without come last. ``sizes`` holds the words of the first unit in its lower half and those of the second
    in its upper.
    """
    rank = F.coalesce(col(doc_id).cast("long"), F.lit(_LAST_ID)).alias("rank")
    given = docs.select(rank, text_hash(doc_id, text).alias("mark"), col(text).alias("text")).where("text is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower = _lower()
        for batch in batches:
            ranks = batch.column(0).to_numpy(zero_copy_only=False)
            marks = batch.column(1).to_numpy(zero_copy_only=False)
            for at in range(0, batch.num_rows, 512):
                found = [units_of(x.as_py(), lower, window) for x in batch.column(2)[at : at + 512]]
                found = [pairs_of(*x) for x in found]
                sizes = [len(x[0]) for x in found]
                if not sum(sizes):
                    continue
                digest, start, end, words = (np.concatenate(x) for x in zip(*found, strict=True))
                numbers = np.concatenate([np.arange(n) for n in sizes])
                columns = [
                    pa.array(np.repeat(ranks[at : at + 512], sizes)),
                    pa.array(np.repeat(marks[at : at + 512], sizes)),
                    pa.array(numbers, pa.int32()),
                    pa.array(digest.view(np.int64)),
                    pa.array(start, pa.int64()),
                    pa.array(end, pa.int64()),
                    pa.array(words, pa.int32()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["rank", "mark", "unit", "digest", "start", "end", "sizes"])

    return given.mapInArrow(run, "rank long, mark long, unit int, digest long, start long, end long, sizes int")


def _later(found: DataFrame, within: bool) -> DataFrame:
    """The rows of :func:`pairs` whose digest has an earlier place, with its ``owner``.

    Frequent digests (Misra-Gries, so every one above HOT is among them) are not shuffled by digest: their first places, summed in the
    scan tasks, are broadcast. Of what is shuffled no digest holds more than HOT of the rows.
    """
    # rows without an id are told apart by their mark, others are documents by their id
    nameless = F.when(F.col("rank") == _LAST_ID, F.col("mark"))
    parts = ["rank", nameless] if not within else ["rank", "mark", "unit"]
    place = F.struct(*[F.coalesce(c, F.lit(0)).alias(f"p{i}") for i, c in enumerate(parts)])
    first = F.min(place).alias("first")

    frequent = found.stat.freqItems(["digest"], HOT).select(F.explode("digest_freqItems").alias("digest"))
    frequent = stored(frequent, "frequent")
    hot = found.join(F.broadcast(frequent), "digest", "left_semi")
    heads = stored(hot.groupBy("digest").agg(first), "heads")
    hot = hot.join(F.broadcast(heads), "digest")

    # few digests occur twice; only their rows are compared
    cold = found.join(F.broadcast(frequent), "digest", "left_anti")
    twice = cold.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    cold = stored(cold.join(twice, "digest", "left_semi"), "repeated")
    cold = cold.join(cold.groupBy("digest").agg(first), "digest")
    return hot.unionByName(cold).where(place != F.col("first")).withColumn("owner", F.col("first.p0"))


def repeated_spans(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    window: int = WINDOW,
    doc_id: str = "doc_id",
    text: str = "text",
    within: bool = False,
) -> DataFrame:
    """What to remove: ``doc_id, mark, start, end, words, keep_id``, offsets in code points of the original text.

    Lines are cut into units (see :func:`units_of`), since a passage may lie inside a line. The digest of two adjacent units is grouped
    over all documents, summed in the scan tasks; the document with the smallest id keeps them, rows without an id coming
    last, and in every other document they are removed if the run of such pairs they stand in has ``min_words - 2 * window`` words or
    more. That is what is left of a passage of ``min_words`` after its edges, and more than one unit, so each such passage
    is found; common units that do not follow each other elsewhere and shorter repeats stay.

    With ``within``, the earliest occurrence by id, mark and place in the text keeps a passage and every other one is removed, also those in
    the same document or in another row of the same id; an occurrence that overlaps the kept one goes from where it repeats. Without it, rows
    with the same id are one document, and repeats inside one stay. Rows without an id are documents by their text;
    ``keep_id`` is NULL if such a row keeps. Repeated rows are one document. NULL, empty and white texts have no units. An empty table
    gives an empty result. Other columns are not read; ids are integers.
    """
    copies = _later(stored(pairs(docs, doc_id, text, window), "pairs"), within)
    # repeated rows have the same units
    copies = copies.groupBy("rank", "mark", "unit").agg(*[F.first(c).alias(c) for c in ("start", "end", "sizes", "owner")])
    order = Window.partitionBy("rank", "mark").orderBy("unit")
    runs = copies.withColumn("run", F.col("unit") - F.row_number().over(order))
    # each first unit, and the second of the last pair
    first, second = F.col("sizes").bitwiseAND(F.lit(0xFFFF)), F.shiftright("sizes", 16)
    words = F.sum(first) + F.max_by(second, "unit")
    spans = runs.groupBy("rank", "mark", "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), words.alias("words"), F.min("owner").alias("owner")
    )
    own = F.when(F.col("rank") != _LAST_ID, F.col("rank")).cast(docs.schema[doc_id].dataType).alias("doc_id")
    keep = F.when(F.col("owner") != _LAST_ID, F.col("owner")).cast(docs.schema[doc_id].dataType).alias("keep_id")
    return spans.where(F.col("words") >= max(min_words - 2 * window, 1)).select(own, "mark", "start", "end", "words", keep)


def remove_spans(docs: DataFrame, spans: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with the spans of :func:`repeated_spans` cut out of their texts, all other columns as they were, and a column
    ``kept`` (another name if taken): start and end, in the original text, of what stays."""
    key, mark, cuts, own = (fresh(docs, n) for n in ("_span_id", "_span_mark", "_cuts", "_mark"))
    listed = spans.groupBy(F.col("doc_id").alias(key), F.col("mark").alias(mark)).agg(
        F.sort_array(F.collect_list(F.struct("start", "end"))).alias(cuts)
    )
    joined = matched(docs.withColumn(own, text_hash(doc_id, text)), stored(listed, "spans"), [(doc_id, key), (own, mark)], "left")
    length = F.length(col(text)).cast("long")
    n = F.size(cuts)
    at = lambda i, f: F.get(col(cuts), i)[f]
    edges = F.transform(
        F.sequence(F.lit(0), n),
        lambda i: F.struct(
            F.when(i == 0, F.lit(0).cast("long")).otherwise(at(i - 1, "end")).alias("start"),
            F.when(i == n, length).otherwise(at(i, "start")).alias("end"),
        ),
    )
    kept = fresh(docs, "kept")
    some = F.filter(F.when(col(cuts).isNotNull(), edges).otherwise(F.array(F.struct(F.lit(0).cast("long").alias("start"), length.alias("end")))), lambda x: x["start"] < x["end"])
    joined = joined.withColumn(kept, some)
    part = F.transform(col(kept), lambda x: F.substring(col(text), (x["start"] + 1).cast("int"), (x["end"] - x["start"]).cast("int")))
    out = F.when(col(cuts).isNull(), col(text)).otherwise(F.array_join(part, ""))
    others = [out.alias(c) if c == text else col(c) for c in docs.columns]
    return joined.select(*others, col(kept))
