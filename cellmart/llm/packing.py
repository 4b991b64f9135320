"""Packing tokenized documents into sequences: best fit planned over a histogram of lengths."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, small, stored, text_hash
from cellmart.llm.tokens import Encoder

CAPACITY = 2048
SEPARATOR = 0
# pieces of one length that are numbered together
BIN_ROWS = 8192
_OUT = "piece int, start long, length long, ids_crc32 long"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def cuts(total: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``total`` ids: whole sequences, after a first piece of what is left over."""
    first = total % capacity or min(total, capacity)
    starts = [0, *range(first, total, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], total], strict=True)]


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` and per piece ``piece, start, length, ids_crc32``; whole texts are encoded, NULL as empty."""
    path = path or tokenizer_path()
    given = docs.select(col(doc_id).alias("doc_id"), text_hash(doc_id, text).alias("mark"), col(text).alias("text"))
    kinds = [T.StructField(n, given.schema[n].dataType) for n in ("doc_id", "mark")]
    schema = T.StructType([*kinds, *T.StructType.fromDDL(_OUT).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        end = np.array([SEPARATOR], "<u4")
        for batch in batches:
            rows, found = [], []
            for i, value in enumerate(batch.column(2)):
                ids = np.concatenate([encoder.ids(value.as_py() or ""), end])
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append(i)
                    found.append((k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            own = pa.RecordBatch.from_arrays(batch.columns[:2], ["doc_id", "mark"]).take(pa.array(rows, pa.int64()))
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            values = [pa.array([x[j] for x in found], t) for j, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*own.columns, *values], schema.names)

    return given.mapInArrow(run, schema)


def plan_slots(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best fit, longest first, over counts of lengths instead of pieces.

    Sequences with the same space left are handled as ranges. A run ``(length, rank, count, sequence, each,
    offset)`` seats the pieces of ``length`` ranked ``rank`` .. ``rank + count - 1``, ``each`` of them side by side from
    ``offset`` in every sequence from ``sequence`` on. The number of runs follows the number of lengths and is
    independent of the number of pieces.
    """
    runs: list[tuple[int, int, int, int, int, int]] = []
    spaces: list[int] = []  # kinds of space left, ascending
    free: dict[int, list[tuple[int, int]]] = {}
    opened = 0

    def give(space: int, first: int, number: int) -> None:
        if number and space:
            if space not in free:
                insort(spaces, space)
                free[space] = []
            free[space].append((first, number))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces[at]
                first, number = free[space].pop()
                if not free[space]:
                    del free[space], spaces[at]
            else:
                space, first, number = capacity, opened, -(-left // (capacity // length))
                opened += number
            each = min(space // length, left)
            used = min(number, left // each)
            runs.append((length, rank, used * each, first, each, capacity - space))
            give(space - each * length, first, used)
            give(space, first + used, number - used)
            rank, left = rank + used * each, left - used * each
    return runs


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per piece of every document: ``doc_id, mark, piece, start, length, ids_crc32, sequence_id, offset``.

    Only the counts of lengths, at most ``capacity`` of them, are collected; the plan over them, some thousand runs, is
    broadcast. Pieces are numbered within their length in bins of a hash, so a length
    that a third of all pieces has is never in one task, and take the slot planned for their rank.

    A NULL or empty text is one piece, the separator alone. Repeated rows are packed each. An empty table gives an empty result.
    Other columns are not read.
    """
    made = stored(pieces(docs, path, capacity, doc_id, text), "pieces")
    counts = {r["length"]: r["count"] for r in made.groupBy("length").count().collect()}
    spark = docs.sparkSession
    bins = [(length, max(1, n // BIN_ROWS)) for length, n in counts.items()]
    bins = F.broadcast(spark.createDataFrame(bins, "length long, bins long"))
    dealt = made.join(bins, "length").withColumn("bin", F.pmod(F.xxhash64("mark", "piece"), F.col("bins"))).drop("bins")
    per_bin = dealt.groupBy("length", "bin").agg(F.count(F.lit(1)).alias("n"))
    running = Window.partitionBy("length").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = stored(per_bin.select("length", "bin", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("before")), "bins")
    order = Window.partitionBy("length", "bin").orderBy("mark", "piece", "doc_id")
    ranked = dealt.withColumn("within", F.row_number().over(order) - 1).join(small(per_bin), ["length", "bin"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within"))
    fields = "slot_length long, first_rank long, seats long, first_sequence long, each long, first_offset long"
    slots = F.broadcast(spark.createDataFrame(plan_slots(counts, capacity), fields))
    place = F.col("rank") - F.col("first_rank")
    seated = (F.col("length") == F.col("slot_length")) & (place >= 0) & (place < F.col("seats"))
    return ranked.join(slots, seated).select(
        "doc_id",
        "mark",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + F.floor(place / F.col("each"))).alias("sequence_id"),
        (F.col("first_offset") + F.pmod(place, "each") * F.col("length")).alias("offset"),
    )
