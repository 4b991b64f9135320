"""Exact top-k search by score histograms, refined until each k-th value is known."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellmart.llm.common import col, stored

BINS = 256
# queries whose vectors are broadcast at a time
QUERY_ROWS = 4096
# scores a task holds at a time
AT_ONCE = 1 << 21
# scores and the width of their range must fit a long; a larger score stops the job
LIMIT = 1 << 61
_EXACT = 1 << 53


def quantized(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 64.0) -> DataFrame:
    """``vec_id`` and ``v``, floor(scale * x) per component, as doubles; rows with a NULL id, vector or component, or a
    component that is not finite, are left out. Repeated rows stay."""
    whole = F.forall(col(embedding), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(col(vec_id).isNotNull() & col(embedding).isNotNull() & whole)
    rows = rows.select(col(vec_id).cast("long").alias("vec_id"), col(embedding).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False))
            ends = np.cumsum(np.r_[0, lists.value_lengths().to_numpy(zero_copy_only=False)])
            values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], ["vec_id", "v"])

    return rows.mapInArrow(run, "vec_id long, v array<double>")


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Rows of equal length; shorter vectors end in zeros."""
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _exact_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers that doubles cannot hold, exact, by halves.

    Each component is ``high * 2^26 + low``; sums of products of halves fit longs. They are put together modulo 2^64, which is
    exact where the score fits; beside them a sum in doubles tells whether it does. If not, the job stops.
    """
    half = float(1 << 26)
    highs = [np.floor(x / half) for x in (a, b)]
    if max(np.abs(x).max(initial=0) for x in highs) >= half:
        raise OverflowError(f"a component of 2^52 or more: scores may not fit {LIMIT}")
    parts = [[(x - high * half).astype(np.int64), high.astype(np.int64)] for x, high in zip((a, b), highs, strict=True)]
    total, rough = np.zeros((len(a), len(b)), np.int64), np.zeros((len(a), len(b)))
    for at in range(0, a.shape[1], 1024):
        for i, left in enumerate(parts[0]):
            for j, right in enumerate(parts[1]):
                product = left[:, at : at + 1024] @ right[:, at : at + 1024].T
                total += product << (26 * (i + j))
                rough += product * 2.0 ** (26 * (i + j))
    if rough.size and np.abs(rough).max() > LIMIT:
        raise OverflowError(f"a score beyond {LIMIT} in size")
    return total


class _Block:
    """Queries of one pass, with where each k-th score is known to lie: in ``low`` .. ``low + span - 1``."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, largest: float) -> None:
        self.ids, self.vectors = ids, vectors
        reach = np.ceil(np.sqrt((vectors**2).sum(1)) * largest) + 1
        self.exact = bool((reach < _EXACT).all())
        reach = np.minimum(reach, float(LIMIT)).astype(np.int64)
        self.low = -reach
        self.span = 2 * reach + 1
        self.above = np.zeros(len(ids), np.int64)
        self.known = np.zeros(len(ids), bool)

    @property
    def width(self) -> np.ndarray:
        """Of the bins that the range is counted in."""
        return -(-self.span // BINS)

    def scores(self, ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        """Integer scores, queries by rows; a query's own row gets a value below any other."""
        if self.exact:
            # sums of integers below 2^53 are exact in doubles, in any order
            found = (self.vectors @ vectors.T).astype(np.int64)
        else:
            found = _exact_products(self.vectors, vectors)
        order = np.argsort(self.ids, kind="stable")
        at = np.searchsorted(self.ids, ids, sorter=order)
        while (inside := at < len(order)).any():
            same = np.zeros(len(ids), bool)
            same[inside] = self.ids[order[at[inside]]] == ids[inside]
            if not same.any():
                break
            found[order[at[same]], np.flatnonzero(same)] = -LIMIT - 1
            at = np.where(same, at + 1, len(order))
        return found

    def batches(self, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        step = max(1, AT_ONCE // len(self.ids))
        for batch in batches:
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                ids = part.column(0).to_numpy(zero_copy_only=False)
                yield ids, self.scores(ids, _matrix(part.column(1), self.vectors.shape[1]))


def _histogram(rows: DataFrame, block: _Block, k: int) -> DataFrame:
    """``(query, bin, n)``: candidates per bin of each query's range, from the highest bin to where a task has k.

    A bin below that in one task cannot hold the k-th score of all, so the sums are complete down to its bin.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vars(block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block.__new__(_Block)
        block.__dict__.update(shared.value)
        counts = np.zeros(len(block.ids) * BINS, np.int64)
        low, top, width = block.low[:, None], (block.low + block.span)[:, None], block.width
        for _, scores in block.batches(batches):
            q, c = np.nonzero((scores >= low) & (scores < top))
            bins = (scores[q, c] - block.low[q]) // width[q]
            counts += np.bincount(q * BINS + bins, minlength=len(counts))
        counts = counts.reshape(-1, BINS)
        higher = counts[:, ::-1].cumsum(1)[:, ::-1] - counts
        q, b = np.nonzero((counts > 0) & (higher < k))
        columns = [pa.array(q, pa.int64()), pa.array(b, pa.int64()), pa.array(counts[q, b], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, ["query", "bin", "n"])

    found = rows.mapInArrow(run, "query long, bin long, n long")
    return found.groupBy("query", "bin").agg(F.sum("n").alias("n"))


def _refine(rows: DataFrame, block: _Block, k: int) -> None:
    """One round: narrows each query's range to the bin that holds its k-th score; a row per query reaches the driver."""
    order = Window.partitionBy("query").orderBy(F.desc("bin"))
    spark = rows.sparkSession
    above = spark.createDataFrame([(i, int(n)) for i, n in enumerate(block.above)], "query long, above long")
    summed = _histogram(rows, block, k).join(F.broadcast(above), "query")
    upto = F.col("above") + F.sum("n").over(order)
    hit = summed.withColumn("upto", upto).where((F.col("upto") >= k) & (F.col("upto") - F.col("n") < k))
    got = hit.select("query", "bin", (F.col("upto") - F.col("n")).alias("above")).toArrow()
    q, b = got["query"].to_numpy(), got["bin"].to_numpy()
    width = block.width
    block.above[q] = got["above"].to_numpy()
    block.low[q] += b * width[q]
    block.known[q] = width[q] == 1
    block.span = width
    # queries with fewer than k candidates take all of them
    few = np.setdiff1d(np.arange(len(block.ids)), q)
    block.low[few], block.known[few] = -LIMIT, True


def _winners(rows: DataFrame, block: _Block, k: int) -> DataFrame:
    """Candidates from each query's k-th score up; of equal scores a task keeps the k smallest ids."""
    shared = rows.sparkSession.sparkContext.broadcast(vars(block))

    def best(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        q, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((ids, -scores, q))
        q, ids, scores = q[order], ids[order], scores[order]
        first = np.r_[True, q[1:] != q[:-1]]
        rank = np.arange(len(q)) - np.maximum.accumulate(np.where(first, np.arange(len(q)), 0))
        return q[rank < k], ids[rank < k], scores[rank < k]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _Block.__new__(_Block)
        block.__dict__.update(shared.value)
        found: list[tuple[np.ndarray, ...]] = []
        held = 0
        for ids, scores in block.batches(batches):
            q, c = np.nonzero(scores >= block.low[:, None])
            if len(q):
                found.append((q, ids[c], scores[q, c]))
                held += len(q)
            if held >= AT_ONCE:
                found = [best(found)]
                held = 0
        if found:
            q, ids, scores = best(found)
            columns = [pa.array(block.ids[q], pa.int64()), pa.array(ids, pa.int64()), pa.array(scores, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    found = rows.mapInArrow(run, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each vector that ``queries`` selects.

    Every row is scored, in blocks of queries times blocks of rows; scores stay in the task. Each round sums
    histograms over all tasks and narrows every query's range to the bin of its k-th score, until that
    bin is one value; then only scores from there up leave the tasks, and ties go to the smaller id. Queries go in
    blocks of about ``QUERY_ROWS``, whose vectors are broadcast.

    Vectors that are NULL, hold NULL or are not finite, and rows without an id, take no part. Shorter vectors count as if
    they ended in zeros. A query's own row is any row with its id; otherwise repeated rows are candidates each, and an
    id that several query rows have is answered once, for its smallest vector. With fewer than ``k``
    candidates all are returned; without queries the result is empty. ``queries`` is a condition on the column
    ``vec_id``. Scores are exact; one beyond 2^61 in size, or a component beyond 2^52 among such, stops the job.
    """
    rows = stored(quantized(vectors, vec_id, embedding), "vectors")
    asked = rows.where(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    stats = rows.agg(F.max(F.size("v")).alias("dims"), F.sqrt(F.max(square)).alias("norm")).first()
    dims, total = stats["dims"] or 0, asked.count()
    blocks = -(-total // QUERY_ROWS)
    asked = stored(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(max(blocks, 1))).cast("int")), "queries")
    result = None
    for number in range(blocks):
        got = asked.where(F.col("block") == number).toArrow().combine_chunks()
        if not got.num_rows:
            continue
        ids = got["vec_id"].to_numpy()
        vectors_ = _matrix(got["v"].combine_chunks(), dims)
        block = _Block(ids, vectors_, float(stats["norm"]))
        while not block.known.all():
            _refine(rows, block, k)
        found = stored(_winners(rows, block, k), "winners")
        result = found if result is None else result.unionByName(found)
    if result is None:
        result = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return result
