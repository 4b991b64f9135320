"""Vectors as exact integers, and sums of them per cell that no order of tasks changes."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellmart.llm.common import col

# integers of at most this size are exact as doubles, so are their sums and products below it
EXACT = 1 << 53
# components beyond it stop the job: their squared distances fit no long
LARGEST = 1 << 62
# rows that a task computes with at a time
BLOCK = 4096

Cells = Callable[[np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]


def integers(vectors: DataFrame, scale: float, embedding: str, **others: str) -> DataFrame:
    """``v``, floor(scale * x) per component as longs, and the columns ``others`` names (new name to old).

    Vectors that are NULL or hold NULL or non-finite components are left out; a component beyond 2^62 stops the job.
    """
    whole = F.forall(col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(col(embedding).isNotNull() & whole)

    def floored(x):
        scaled = F.floor(x.cast("double") * F.lit(scale))
        return F.when(F.abs(x.cast("double") * F.lit(scale)) >= float(LARGEST), F.raise_error(F.lit("component beyond 2^62"))).otherwise(scaled).cast("long")

    return rows.select(*[col(old).alias(new) for new, old in others.items()], F.transform(col(embedding), floored).alias("v"))


def blocks(batch: pa.RecordBatch, name: str, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with their vectors as rows of longs; shorter vectors end in zeros."""
    for at in range(0, batch.num_rows, BLOCK):
        part = batch.slice(at, BLOCK)
        lists = part.column(part.schema.get_field_index(name))
        lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        out = np.zeros((len(lengths), dims), np.int64)
        out[np.arange(dims) < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
        yield part, out


def largest(x: np.ndarray) -> int:
    return max(int(x.max()), -int(x.min())) if x.size else 0


def numbers(x: np.ndarray, exact: bool) -> np.ndarray:
    """Doubles where all that follows stays below 2^53, else Python's integers."""
    return x.astype(np.float64) if exact else x.astype(object)


def longs(x: np.ndarray) -> np.ndarray:
    """Whole numbers as longs; one that fits none stops the job."""
    if x.dtype == object and len(x) and max(x) >= 1 << 63:
        raise OverflowError("a squared distance fits no long")
    return x.astype(np.int64)


def cell_sums(rows: DataFrame, dims: int, cells: Cells, n_cells: int, width: int) -> tuple[list[int], list[list[int]]]:
    """Per cell, how many vectors it has, and their sums by component.

    ``cells`` gives, for a block of vectors, arrays of cell numbers and the vectors that count there. Tasks sum before
    the shuffle, in integers; at most ``n_cells * (width + 1)`` numbers reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_cells, np.int64)
        totals = np.zeros((n_cells, width), object)
        for batch in batches:
            for _, x in blocks(batch, "v", dims):
                exact = largest(x) < (1 << 62) // BLOCK
                for cell, values in cells(x):
                    part = np.zeros((n_cells, width), np.int64 if exact else object)
                    np.add.at(part, cell, values if exact else values.astype(object))
                    totals += part
                    counts += np.bincount(cell, minlength=n_cells)
        for cell in np.flatnonzero(counts):
            sums = [Decimal(int(counts[cell])), *(Decimal(int(s)) for s in totals[cell])]
            yield pa.RecordBatch.from_arrays(
                [pa.array([cell] * (width + 1), pa.int32()), pa.array(range(-1, width), pa.int32()), pa.array(sums, pa.decimal128(38, 0))],
                ["cell", "at", "total"],
            )

    found = rows.select("v").mapInArrow(run, "cell int, at int, total decimal(38,0)")
    counts, sums = [0] * n_cells, [[0] * width for _ in range(n_cells)]
    for cell, at, total in found.groupBy("cell", "at").agg(F.sum("total")).collect():
        if at < 0:
            counts[cell] = int(total)
        else:
            sums[cell][at] = int(total)
    return counts, sums


def moved(entries: np.ndarray, counts: list[int], sums: list[list[int]]) -> np.ndarray:
    """Entries at the floor of their vectors' mean; those without vectors stay."""
    means = [[s // n for s in total] if n else list(map(int, old)) for old, n, total in zip(entries, counts, sums, strict=True)]
    return np.array(means, np.int64).reshape(entries.shape)
