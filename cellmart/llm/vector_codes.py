"""Vector compression by product codes; each part finds its entry in a geometric near-neighbour access tree."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import stored
from cellmart.llm.vectors import EXACT, blocks, cell_sums, integers, largest, longs, moved, numbers
from cellmart.operators.sizing import dim_join

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096.0
# split points of a node, and the entries up to which a node is not split
DEGREE = 4
LEAF = 3
# bytes of codebooks that are sent to every task
CODEBOOK_BYTES = 64 * 1024 * 1024
# relative room left for the rounding of roots, sums and differences
_ROOM = 2.0**-48


def _roots(squares: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the distances from below and above, whatever the rounding."""
    root = np.sqrt(squares.astype(np.float64))
    return root * (1 - _ROOM), root * (1 + _ROOM)


@dataclass
class _Node:
    """``splits`` are entries; child ``j`` holds the entries nearest to split ``j``. Every distance from split ``i`` to split
    ``j`` or an entry below it lies in ``low[i, j] .. high[i, j]``; at ``i = j`` only those below it count."""

    splits: np.ndarray
    low: np.ndarray
    high: np.ndarray
    children: list["_Node | None"]


class Gnat:
    """Entries in a tree of split points that store how near and far each child's entries are."""

    def __init__(self, entries: np.ndarray, degree: int = DEGREE, leaf: int = LEAF) -> None:
        self.entries = entries
        self.degree, self.leaf = degree, leaf
        self.whole = entries.astype(object)
        self.root = self._build(np.arange(len(entries)))

    def _squares(self, a: int, others: np.ndarray) -> np.ndarray:
        apart = self.whole[others] - self.whole[a]
        return (apart * apart).sum(1)

    def _build(self, members: np.ndarray) -> _Node | None:
        if not len(members):
            return None
        splits = [members[0]]
        if len(members) > self.leaf:
            # each next split point is the entry farthest from those chosen
            near = self._squares(members[0], members)
            while len(splits) < self.degree:
                splits.append(members[int(np.argmax(near))])
                near = np.minimum(near, self._squares(splits[-1], members))
        else:
            splits = list(members)
        splits = np.array(list(dict.fromkeys(splits)))
        rest = np.setdiff1d(members, splits)
        squares = np.array([self._squares(s, rest) for s in splits]).reshape(len(splits), len(rest))
        home = squares.argmin(0) if len(rest) else np.zeros(0, np.int64)
        low, high = np.full((2, len(splits), len(splits)), np.inf)
        high = -high
        for i, s in enumerate(splits):
            for j in range(len(splits)):
                below = rest[home == j] if i == j else np.r_[splits[j], rest[home == j]]
                if len(below):
                    down, up = _roots(self._squares(s, below))
                    low[i, j], high[i, j] = down.min(), up.max()
        return _Node(splits, low, high, [self._build(rest[home == j]) for j in range(len(splits))])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Lowest number of the nearest entries and the squared distance for each row of longs, and how many distances it took.

        A query's distance to a split point bounds its distance to all entries below every other: a subtree goes only where that
        bound, rounded down, is above the best distance so far, rounded up, so none that ties is lost. Ties and minima are
        decided by integers.
        """
        exact = 4 * x.shape[1] * (largest(x) + largest(self.entries) + 1) ** 2 < EXACT
        given, entries = numbers(x, exact), numbers(self.entries, exact)
        best = np.full(len(x), np.inf if exact else (1 << 200), given.dtype)
        number = np.full(len(x), len(entries), np.int64)
        taken = 0

        def visit(node: _Node, rows: np.ndarray) -> None:
            nonlocal taken
            bound = np.zeros((len(rows), len(node.splits)))
            for i, entry in enumerate(node.splits):
                alive = np.flatnonzero(bound[:, i] <= _roots(best[rows])[1])
                if not len(alive):
                    continue
                at = rows[alive]
                apart = given[at] - entries[entry]
                square = (apart * apart).sum(1)
                taken += len(at)
                better = ((square < best[at]) | ((square == best[at]) & (entry < number[at]))).astype(bool)
                best[at[better]], number[at[better]] = square[better], entry
                down, up = _roots(square)
                # entries below split j are at least this far from the query
                least = np.maximum(node.low[i] - up[:, None], down[:, None] - node.high[i])
                slack = _ROOM * (up[:, None] + np.where(np.isfinite(node.high[i]), node.high[i], 0.0))
                bound[alive] = np.maximum(bound[alive], least - slack)
            reach = _roots(best[rows])[1]
            for j, child in enumerate(node.children):
                if child is not None:
                    left = rows[bound[:, j] <= reach]
                    if len(left):
                        visit(child, left)

        if self.root is not None and len(x):
            visit(self.root, np.arange(len(x)))
        return number, longs(best) if len(x) else np.zeros(0, np.int64), taken


@dataclass
class Codebooks:
    """A tree per part; ``entries`` is parts x entries x components."""

    entries: np.ndarray

    def __post_init__(self) -> None:
        self.trees = [Gnat(e) for e in self.entries]

    def codes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry numbers and squared distances, rows by parts."""
        parts = x.reshape(len(x), len(self.trees), -1)
        found = [tree.nearest(parts[:, p])[:2] for p, tree in enumerate(self.trees)]
        return np.stack([f[0] for f in found], 1), np.stack([f[1] for f in found], 1)

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256`` per vector.

    Components are the integers floor(scale * x); vectors are cut into ``parts`` equal consecutive parts, each with a codebook
    that starts as that part of the vectors with the ``entries`` smallest ids. A round assigns every part to its nearest
    entry (squared distance, ties to the lower number) and moves each entry to the floor of its parts' mean; unused ones stay.
    Sums are made in the tasks, in integers: the same for any order or loss of tasks. The codebooks, ``entries`` vectors
    (at most 64 MB), are all that the driver holds. Errors per label are summed before the shuffle and joined back with
    salts if there are many labels.

    Vectors that are NULL or hold NULL or non-finite components are left out. Rows without an id are coded but start no
    codebook; repeated rows count each, equal ids in the order of their components. NULL labels are one label. If lengths differ or
    are no multiple of ``parts``, vectors count as if they ended in zeros. With fewer vectors than entries there are as many entries as
    vectors with an id; without any the result is empty. Components beyond 2^62, and errors beyond a long, stop the job.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = stored(integers(vectors, scale, embedding, vec_id=vec_id, label=label), "vectors")
    spark = rows.sparkSession
    first = rows.where(F.col("vec_id").isNotNull()).orderBy("vec_id", "v").limit(entries).select("v").collect()
    kinds = [rows.schema["vec_id"], rows.schema["label"], *T.StructType.fromDDL("code string, error long").fields]
    if not first:
        out = spark.createDataFrame([], T.StructType(kinds)).drop("label")
        return out.select("*", F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    longest = rows.agg(F.max(F.size("v"))).first()[0]
    width = max(1, -(-longest // parts))
    dims = width * parts
    if 8 * entries * dims > CODEBOOK_BYTES:
        raise ValueError(f"codebooks take over {CODEBOOK_BYTES} bytes")
    start = np.array([list(r.v) + [0] * (dims - len(r.v)) for r in first], np.int64)
    books = start.reshape(len(first), parts, width).swapaxes(0, 1)
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)

        def cells(x: np.ndarray, shared=shared, made={}) -> Iterator[tuple[np.ndarray, np.ndarray]]:  # noqa: B006
            if not made:
                made[0] = Codebooks(shared.value)
            n = shared.value.shape[1]
            number, _ = made[0].codes(x)
            for p in range(parts):
                yield p * n + number[:, p], x[:, p * width : (p + 1) * width]

        counts, sums = cell_sums(rows, dims, cells, parts * len(first), width)
        books = moved(books.reshape(-1, width), counts, sums).reshape(books.shape)
    shared = spark.sparkContext.broadcast(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Codebooks(shared.value)
        for batch in batches:
            for part, x in blocks(batch, "v", dims):
                number, squares = made.codes(x)
                codes = [bytes(c).hex() for c in number.astype(np.uint8)]
                error = longs(squares.astype(object).sum(1))
                yield pa.RecordBatch.from_arrays([*part.columns[:2], pa.array(codes, pa.string()), pa.array(error)], ["vec_id", "label", "code", "error"])

    coded = stored(rows.mapInArrow(run, T.StructType(kinds)), "coded")
    by_label = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).cast("long").alias("label_error"))
    out = dim_join(coded, stored(by_label, "label-errors"), ["label"], null_safe=True)
    return out.select("vec_id", "code", "error", "label_error", F.lit(Codebooks(books).digest).alias("codebooks_sha256"))
