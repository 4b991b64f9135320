"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, fresh

GRAMS = (1, 2, 3)
BUCKETS = 1 << 16
SMOOTHING = 0.5
# labelled documents per language, on average, that the model is fitted on
TRAIN_ROWS = 4000
# characters scored at a time
BLOCK = 1 << 18
# n-grams that count as independent evidence for the score
EVIDENCE = 30.0
UNKNOWN = "und"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _buckets(text: str, buckets: int, grams: Sequence[int]) -> Iterator[np.ndarray]:
    """Hashed n-grams of the lower-cased text with a space at both ends, in blocks of characters."""
    whole = f" {text.lower()} ".encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(whole, "<u4")
    shift = np.uint64(64 - (buckets - 1).bit_length())
    most = max(grams)
    for at in range(0, len(codes), BLOCK):
        block = codes[at : at + BLOCK + most - 1].astype(np.uint64)
        n_here = min(BLOCK, len(codes) - at)
        rolled = np.zeros(len(block), np.uint64)
        for n in range(1, most + 1):
            size = len(block) - n + 1
            if size <= 0:
                break
            rolled = rolled[:size] * np.uint64(1_000_003) + block[n - 1 :]
            if n in grams:
                yield (((rolled[:n_here] ^ np.uint64(n)) * _MIX) >> shift).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


@dataclass(frozen=True)
class Model:
    """Languages in order, their log priors, and log probabilities of buckets, one row per bucket."""

    langs: tuple[str, ...]
    prior: np.ndarray
    table: np.ndarray
    grams: tuple[int, ...]

    def score(self, texts: Sequence[str | None]) -> tuple[list[str], list[float]]:
        """Language and a probability per text; ``und`` and 0 without a letter or without a model.

        The n-grams of the batch lie behind each other as one sparse matrix of counts, whose product with the table is
        a sum of its rows per text. Long texts come in blocks.
        """
        sums = np.tile(self.prior, (len(texts), 1)) if self.langs else np.zeros((len(texts), 0))
        grams = np.zeros(len(texts))
        rows: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def add() -> None:
            nonlocal rows, parts, held
            if parts:
                ends = np.cumsum([len(p) for p in parts])
                values = np.add.reduceat(self.table[np.concatenate(parts)], np.r_[0, ends[:-1]], axis=0, dtype=np.float64)
                np.add.at(sums, rows, values)
            rows, parts, held = [], [], 0

        judged = np.array([bool(self.langs) and has_letter(t) for t in texts], bool)
        for i in np.flatnonzero(judged):
            for found in _buckets(texts[i], self.table.shape[0], self.grams):
                rows.append(int(i))
                parts.append(found)
                held += len(found)
                grams[i] += len(found)
                if held >= BLOCK:
                    add()
        add()
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        # neighbouring n-grams overlap and are no independent evidence: the score is damped to that of EVIDENCE of them
        damped = sums * np.minimum(1.0, EVIDENCE / np.maximum(grams, 1))[:, None]
        odds = np.exp(damped - damped.max(1, keepdims=True))
        best = sums.argmax(1)
        chance = odds[np.arange(len(texts)), best] / odds.sum(1)
        langs = [self.langs[b] if ok else UNKNOWN for b, ok in zip(best, judged, strict=True)]
        return langs, [float(c) if ok else 0.0 for c, ok in zip(chance, judged, strict=True)]


def held_out(doc_id: Column) -> Column:
    """Rows that are never learned from: ``crc32(id as text) mod 4 = 2``, and rows without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def fit(
    docs: DataFrame,
    train_rows: int = TRAIN_ROWS,
    buckets: int = BUCKETS,
    grams: Sequence[int] = GRAMS,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
) -> Model:
    """Counts n-grams of the labelled documents that are not held out.

    At most about ``train_rows`` documents of a language are used, chosen by a hash of their id and text. The counts reach the
    driver as one row per language and bucket seen, at most ``languages * buckets`` numbers.
    """
    named = docs.select(
        col(lang).cast("string").alias("lang"),
        col(text).alias("text"),
        F.shiftrightunsigned(F.xxhash64(col(doc_id), col(text), F.lit("fit")), 11).alias("h"),
    ).where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(col(doc_id)))
    rows = {r["lang"]: r["n"] for r in named.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not rows:
        return Model((), np.zeros(0), np.zeros((buckets, 0), np.float32), tuple(grams))
    langs = tuple(sorted(rows))
    limits = [(x, i, min(1 << 53, int((1 << 53) * train_rows / rows[x]))) for i, x in enumerate(langs)]
    limits = docs.sparkSession.createDataFrame(limits, "lang string, place int, bound long")
    chosen = named.join(F.broadcast(limits), "lang").where("h < bound").select("place", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for place, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for found in _buckets(value.as_py(), buckets, grams):
                    into = counts.setdefault(place, np.zeros(buckets, np.int64))
                    into += np.bincount(found, minlength=buckets)
        for place, into in counts.items():
            seen = np.flatnonzero(into)
            arrays = [pa.array(np.full(len(seen), place, np.int32)), pa.array(seen), pa.array(into[seen])]
            yield pa.RecordBatch.from_arrays(arrays, ["place", "bucket", "n"])

    summed = chosen.mapInArrow(run, "place int, bucket long, n long").groupBy("place", "bucket").agg(F.sum("n").alias("n"))
    counts = np.full((buckets, len(langs)), SMOOTHING)
    got = summed.toArrow()
    counts[got["bucket"].to_numpy(), got["place"].to_numpy()] += got["n"].to_numpy()
    prior = np.log(np.array([rows[x] for x in langs], float) / sum(rows.values()))
    return Model(langs, prior, np.log(counts / counts.sum(0)).astype(np.float32), tuple(grams))


def predict(docs: DataFrame, model: Model, text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """``docs`` with a language and its score, from the whole text alone; the model is broadcast.

    NULL texts and texts without a letter are ``und`` with score 0; so is everything if nothing was labelled. Equal texts
    get equal results. An empty table gives an empty result. ``lang_pred`` and ``score`` must not be columns of ``docs``.
    """
    parts = (model.langs, model.prior, model.table, model.grams)
    shared = docs.sparkSession.sparkContext.broadcast(parts)
    at = docs.columns.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField(lang_pred, T.StringType()), T.StructField(score, T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        for batch in batches:
            langs, scores = [], []
            for start in range(0, batch.num_rows, 256):
                found = model.score(batch.column(at)[start : start + 256].to_pylist())
                langs += found[0]
                scores += found[1]
            arrays = [*batch.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())]
            yield pa.RecordBatch.from_arrays(arrays, schema.names)

    return docs.mapInArrow(run, schema)


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` per row; labels, sources and ids are never inputs of a prediction."""
    model = fit(docs, doc_id=doc_id, text=text, lang=lang)
    given = docs.select(col(doc_id).alias("doc_id"), held_out(col(doc_id)).alias("held_out"), col(text).alias("text"))
    return predict(given, model).drop("text")


def keep_identified(docs: DataFrame, min_score: float = 0.0) -> DataFrame:
    """``docs`` without the rows whose text has no letter, or whose score is below ``min_score``; all columns as they were."""
    model = fit(docs)
    lang_pred, score = fresh(docs, "_lang_pred"), fresh(docs, "_score")
    found = predict(docs, model, lang_pred=lang_pred, score=score)
    return found.where((col(lang_pred) != UNKNOWN) & (col(score) >= min_score)).drop(lang_pred, score)
