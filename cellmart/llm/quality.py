"""Quality scores: random Fourier features of document statistics, ridge scores by summed normal equations, isotonic calibration."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, small, stored
from cellmart.llm.langid import held_out
from cellmart.llm.vectors import cell_sums

# labelled documents, on average, that the model is fitted on; a quarter of them calibrates
TRAIN_ROWS = 24_000
FEATURES = 256
# width of the Gaussian kernel over standardised statistics, as a multiple of the root of their number
WIDTH = 2.0
RIDGE = 1e-3
THRESHOLD = 0.7
SEED = 13
# ridge scores are counted in bins of this width before they are calibrated
BIN = 2.0**-10
# fixed point of statistics, features and labels: sums in integers are the same in any order
UNIT = 4096
# characters that are classed at a time
BLOCK = 1 << 20

_LOWER, _UPPER, _LETTER, _DIGIT, _STOP, _SYMBOL, _SPACE, _LINE, _REST = range(9)
_KINDS = {"Ll": _LOWER, "Lu": _UPPER, "Lt": _UPPER, "L": _LETTER, "M": _LETTER, "N": _DIGIT, "P": _SYMBOL, "S": _SYMBOL, "Z": _SPACE}
NAMES = (
    "characters", "words", "upper", "letters", "digits", "stops", "symbols", "spaces", "word_length", "joints", "distinct_words",
    "distinct_pairs", "same_in_a_row", "top_word", "word_entropy", "lines", "distinct_lines", "ended_lines", "line_length", "char_entropy",
)


def _kind_of(code: int) -> int:
    char = chr(code)
    if char == "\n":
        return _LINE
    if char in ".,;:?'\"-":
        return _STOP
    category = unicodedata.category(char)
    return _SPACE if char.isspace() else _KINDS.get(category, _KINDS.get(category[0], _REST))


_TABLE = np.array([_kind_of(c) for c in range(1 << 16)], np.uint8)


def _entropy(counts: np.ndarray) -> float:
    total = counts.sum()
    share = counts[counts > 0] / max(total, 1)
    return float(-(share * np.log2(share)).sum())


def statistics(text: str | None) -> np.ndarray:
    """The statistics ``NAMES`` of a whole text in units of 1/4096; all 0 for NULL and empty ones.

    Lengths are logarithms, the others shares of characters, words or lines, or bits.
    """
    if not text:
        return np.zeros(len(NAMES), np.int64)
    kinds, folded, joints, last = np.zeros(9, np.int64), np.zeros(1024, np.int64), 0, _SPACE
    for at in range(0, len(text), BLOCK):
        codes = np.frombuffer(text[at : at + BLOCK].encode("utf-32-le", "surrogatepass"), "<u4")
        found = np.where(codes < len(_TABLE), _TABLE[np.minimum(codes, len(_TABLE) - 1)], np.where((codes >> 12) == 0x1F, _SYMBOL, _LETTER))
        kinds += np.bincount(found, minlength=9)
        folded += np.bincount(codes & 1023, minlength=1024)
        # a symbol right behind a letter
        before = np.r_[last, found[:-1]]
        joints += int(((found == _SYMBOL) & (before <= _LETTER)).sum())
        last = int(found[-1])
    words = text.split()
    seen: dict[str, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * (len(seen) + 1) + ids[1:]
    uses = np.bincount(ids) if len(ids) else np.zeros(1, np.int64)
    lines = [x for x in (line.strip() for line in text.split("\n")) if x]
    n, w, k = len(text), max(len(words), 1), max(len(lines), 1)
    letters = int(kinds[[_LOWER, _UPPER, _LETTER]].sum())
    values = [
        np.log1p(n), np.log1p(len(words)), kinds[_UPPER] / max(letters, 1), letters / n, kinds[_DIGIT] / n, kinds[_STOP] / n, kinds[_SYMBOL] / n,
        (kinds[_SPACE] + kinds[_LINE]) / n, np.log1p((n - kinds[_SPACE] - kinds[_LINE]) / w), joints / w, len(seen) / w,
        len(np.unique(pairs)) / max(len(pairs), 1), int((ids[1:] == ids[:-1]).sum()) / w, uses.max() / w, _entropy(uses), np.log1p(len(lines)),
        len(set(lines)) / k, sum(x[-1] in ".!?:;\"" for x in lines) / k, np.log1p(n / k), _entropy(folded),
    ]
    return np.rint(np.array(values, float) * UNIT).astype(np.int64)


def pooled(at: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pools adjacent violators: places and shares of hits that never fall from one place to the next."""
    blocks: list[list[float]] = []
    for a, c, h in zip(at, n, hits, strict=True):
        blocks.append([a * c, c, h])
        while len(blocks) > 1 and blocks[-2][2] * blocks[-1][1] >= blocks[-1][2] * blocks[-2][1]:
            for i, x in enumerate(blocks.pop()):
                blocks[-1][i] += x
    places, counts, found = np.array(blocks, float).reshape(-1, 3).T
    return places / counts, found / counts


@dataclass(frozen=True)
class Model:
    """Means and scales of the statistics, directions and phases of the features, weights (the last one is the constant's), and
    the calibration's knots."""

    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    places: np.ndarray
    shares: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosines whose products average to the Gaussian kernel, and a constant, in units of 1/4096."""
        standard = np.clip((x - self.mean) / self.scale, -8, 8)
        waves = np.rint(np.cos(standard @ self.directions + self.phases) * UNIT)
        return np.c_[waves, np.full(len(x), float(UNIT))]

    def ridge(self, x: np.ndarray) -> np.ndarray:
        """Bins of the ridge scores: rounded, so that the size of a batch does not show."""
        return np.rint(self.features(x) @ self.weights / UNIT / BIN).clip(-4096, 8192)

    def score(self, x: np.ndarray) -> np.ndarray:
        if not len(self.places):
            return np.full(len(x), 0.5)
        return np.interp(self.ridge(x), self.places, self.shares)


def _measured(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with the text replaced by its statistics ``v``."""
    at = rows.columns.index(text)
    kept = [f for f in rows.schema.fields if f.name != text]
    schema = T.StructType([*kept, T.StructField("v", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                found = np.array([statistics(t.as_py()) for t in part.column(at)])
                ends = pa.array(np.arange(len(found) + 1) * len(NAMES), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(found.ravel()))
                others = [c for i, c in enumerate(part.columns) if i != at]
                yield pa.RecordBatch.from_arrays([*others, lists], schema.names)

    return rows.mapInArrow(run, schema)


def _matrix(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NAMES))


def sample(docs: DataFrame, labels: DataFrame, doc_id: str, text: str, label: str, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``y`` (mean label in units of 1/4096), ``calibrates`` and ``v`` of about ``train_rows`` labelled documents.

    Chosen by a hash of the id among the labelled ids that are not held out; labels other than 0 and 1 do not count, of
    documents that share an id one is taken.
    """
    named = labels.where(col(label).isin(0, 1) & ~held_out(col(doc_id))).groupBy(col(doc_id).alias("id"))
    named = named.agg(F.round(F.avg(col(label)) * UNIT).cast("long").alias("y"))
    share = F.shiftrightunsigned(F.xxhash64("id", F.lit("quality")), 11)
    bound = min(1 << 53, int((1 << 53) * train_rows / max(named.count(), 1)))
    chosen = stored(named.where(share < bound), "labelled")
    texts = docs.select(col(doc_id).alias("id"), F.coalesce(col(text), F.lit("")).alias("text")).join(small(chosen), "id")
    one = texts.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    calibrates = F.pmod(F.xxhash64("id", F.lit("calibrate")), F.lit(4)) == 0
    return _measured(one.select("y", calibrates.alias("calibrates"), "text"), "text")


def _normal(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the features' products and of features times labels, as integers over 4096 squared.

    A task sums its rows; ``(features + 1)^2`` numbers reach the driver.
    """
    shared = rows.sparkSession.sparkContext.broadcast(vars(model))
    size = FEATURES + 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        total = np.zeros((size, size), np.int64)
        for batch in batches:
            y = batch.column(0).to_numpy(zero_copy_only=False)
            z = np.c_[model.features(_matrix(batch.column(1))), y.astype(float)]
            # exact: a batch's products of integers up to 4096 stay far below 2^53
            total += (z.T @ z).astype(np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(size + 1) * size, pa.int32()), pa.array(total.ravel()))
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), lists], ["i", "row"])

    found = rows.select("y", "v").mapInArrow(run, "i int, row array<long>")
    summed = found.select("i", F.posexplode("row").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x")).toArrow()
    whole = np.zeros((size, size))
    whole[summed["i"].to_numpy(), summed["j"].to_numpy()] = summed["x"].to_numpy()
    return whole[:-1, :-1], whole[:-1, -1]


def fit(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """The model of :func:`sample`'s documents; three quarters of them are fitted, the rest calibrates.

    All that is summed over documents is summed in integers, so reruns agree whatever the order of tasks.
    """
    rows = stored(sample(docs, labels, doc_id, text, label, train_rows), "sample")
    fitted, rest = rows.where(~F.col("calibrates")), rows.where("calibrates")
    d = len(NAMES)

    def squares(x: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        yield np.zeros(len(x), np.int64), np.c_[x, x * x]

    counts, sums = cell_sums(fitted, d, squares, 1, 2 * d)
    n = max(counts[0], 1)
    total = np.array(sums[0], float)
    mean = total[:d] / n
    scale = np.sqrt(np.maximum(total[d:] / n - mean**2, 0))
    scale[scale < 1] = UNIT
    rng = np.random.default_rng(SEED)
    directions = rng.normal(size=(d, FEATURES)) / (WIDTH * np.sqrt(d))
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    none = np.zeros(0)
    model = Model(mean, scale, directions, phases, np.zeros(FEATURES + 1), none, none)
    if not counts[0]:
        return model
    products, target = _normal(fitted, model)
    penalty = RIDGE * counts[0] * UNIT**2 * np.eye(FEATURES + 1)
    penalty[-1, -1] = 0
    model = Model(mean, scale, directions, phases, np.linalg.solve(products + penalty, target), none, none)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            at = model.ridge(_matrix(batch.column(1))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(0)], ["at", "y"])

    # without a labelled document to spare, those fitted calibrate
    used = fitted if rest.isEmpty() else rest
    binned = used.select("y", "v").mapInArrow(run, "at long, y long").groupBy("at").agg(F.count(F.lit(1)).alias("n"), F.sum("y").alias("hits"))
    got = binned.orderBy("at").toArrow()
    places, shares = pooled(*[got[c].to_numpy() for c in ("at", "n", "hits")])
    return Model(mean, scale, directions, phases, model.weights, places, np.clip(shares / UNIT, 0, 1))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = THRESHOLD,
    train_rows: int = TRAIN_ROWS,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` per row of ``docs``, from statistics of the whole text alone.

    Labels of rows with ``crc32(doc_id) mod 4 = 2``, and of rows without an id, are never learned from. About ``train_rows``
    labelled documents are used: the one bound of the model. NULL texts count as empty; empty and very short texts get a
    score like any other. Equal texts get equal scores. Without usable labels every score is 0.5; an empty table gives an
    empty result. Repeated labels of an id count by their mean; other columns are not read.
    """
    model = fit(docs, labels, doc_id, text, label, train_rows)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))
    given = docs.select(col(doc_id).alias("doc_id"), held_out(col(doc_id)).alias("held_out"), col(text).alias("text"))
    schema = T.StructType([*_measured(given, "text").schema.fields[:2], *T.StructType.fromDDL("score double, predicted int").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value)
        for batch in batches:
            if batch.num_rows:
                score = model.score(_matrix(batch.column(2)))
                predicted = pa.array(score >= threshold).cast(pa.int32())
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(score), predicted], schema.names)

    return _measured(given, "text").mapInArrow(run, schema)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows whose text scores below ``threshold``; all columns as they were."""
    judged = F.struct(*[col(c) for c in docs.columns]).alias("row")
    given = docs.select(judged, col("doc_id").alias("doc_id"), col("text").alias("text"))
    model = fit(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        model = Model(**shared.value)
        found = np.array([statistics(t.as_py()) for t in texts]).reshape(-1, len(NAMES))
        return pa.array(model.score(found) >= threshold)

    return given.where(good("text")).select("row.*")
