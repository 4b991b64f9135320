"""Helpers shared by the corpus operators: stored intermediates, row identity, joins back to texts."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.operators.sizing import BROADCAST_BYTES, measured_bytes
from cellmart.session import scratch_path

# what the corpus contracts call white space: space, tab, line feed, vertical tab, form feed, return
SPACE = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and still there after lost executors."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def col(name: str) -> Column:
    return F.col(f"`{name}`")


def text_hash(*names: str) -> Column:
    """64 bits of the named columns; with the id beside it, it tells rows apart whose ids repeat."""
    return F.xxhash64(*[col(n) for n in names])


def small(df: DataFrame) -> DataFrame:
    """``df`` marked for broadcast if its values, measured, are at most 64 MB; else as it is, to be shuffled.

    ``df`` should be stored: measuring it runs it.
    """
    return F.broadcast(df) if measured_bytes(df) <= BROADCAST_BYTES else df


def matched(left: DataFrame, right: DataFrame, on: list[tuple[str, str]], how: str) -> DataFrame:
    """Null-safe join of ``left`` to ``right``, whose columns must not occur in ``left``."""
    condition = reduce(lambda a, b: a & b, [col(a).eqNullSafe(col(b)) for a, b in on])
    return left.join(small(right), condition, how)


def pieces_of(text: Column, spans: Column) -> Column:
    """Array of the pieces of a text that an array of structs ``start, end`` (code points) names.

    Cut in Python, where a place in a string is found at once: in time that follows the text, however many pieces there are.
    """

    @F.arrow_udf("array<string>")
    def cut(texts: pa.Array, places: pa.Array) -> pa.Array:
        found = []
        for text, place in zip(texts, places, strict=True):
            value = text.as_py()
            found.append(None if value is None or not place.is_valid else [value[x["start"] : x["end"]] for x in place.as_py()])
        return pa.array(found, pa.list_(pa.string()))

    return cut(text, spans)


def one_of_each(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each key: the one with the smallest hash of all its columns, so reruns choose alike."""
    rank = fresh(df, "_rank")
    order = Window.partitionBy(*[col(k) for k in keys]).orderBy(F.xxhash64(*[col(c) for c in df.columns]))
    return df.withColumn(rank, F.row_number().over(order)).where(col(rank) == 1).drop(rank)


def without(docs: DataFrame, gone: DataFrame, twins: DataFrame, on: list[tuple[str, str]]) -> DataFrame:
    """``docs`` less the rows with a key in ``gone``, and with one row of each key in ``twins``.

    Rows of one key are copies of each other; ``on`` pairs the key columns of both sides.
    """
    kept = matched(docs, gone, on, "left_anti")
    if twins.isEmpty():
        return kept
    several = one_of_each(matched(kept, twins, on, "left_semi"), [a for a, _ in on])
    return matched(kept, twins, on, "left_anti").unionByName(several)

