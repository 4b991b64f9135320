"""Near duplicates by 64-bit fingerprints: a pigeonhole search over unequal groups of bits."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, fresh, stored, text_hash, without
from cellmart.llm.components import connected

BITS = 64
SEED = 42
DISTANCE = 3
SHINGLE = 3
# hashes whose bits are counted at a time
HASHES = 1 << 16
# what moving one probe to its bucket costs, in compared pairs
PROBE_COST = 100.0
# fingerprints of a bucket that one task compares; larger buckets are dealt out in pairs of such parts
BUCKET_ROWS = 32_768
# buckets up to this size are compared side by side in one vector operation
SIDE_BY_SIDE = 32
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


# ---- fingerprints ---------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of the word shingles: a bit is set if over half of the hashes, repeats counted, set it."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles: Iterator[bytes] = iter([b" ".join(words)])
        total = 1
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)], strict=False))
        total = len(words) - shingle + 1
    set_bits = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, total, HASHES):
        n = min(HASHES, total - at)
        hashes = np.fromiter((digest(next(shingles), SEED) for _ in range(n)), "<u8", n)
        set_bits += np.unpackbits(hashes.view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    packed = np.packbits(2 * set_bits > total, bitorder="little")
    return int(packed.view("<i8")[0])


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` (64 bits of id and text) and the fingerprint ``fp`` as a signed long, one row per row.

    Texts without words (NULL, empty, white space) have fingerprint zero. Whole texts are read, their
    hashes in blocks, so memory follows the words of one text.
    """
    given = docs.select(col(doc_id).alias("doc_id"), text_hash(doc_id, text).alias("mark"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py()) for x in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(found, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "mark", "fp"])

    kinds = [T.StructField(n, given.schema[n].dataType) for n in ("doc_id", "mark")]
    return given.mapInArrow(run, T.StructType([*kinds, T.StructField("fp", T.LongType())]))


# ---- the plan -------------------------------------------------------------


@dataclass(frozen=True)
class Part:
    """A group of bits, and how many of them may differ in a bucket it probes (-1: it is not probed)."""

    bits: tuple[int, ...]
    threshold: int

    @property
    def mask(self) -> int:
        return _signed(sum(1 << b for b in self.bits))

    def flips(self) -> list[int]:
        most = self.threshold
        return [_signed(sum(1 << b for b in c)) for n in range(most + 1) for c in combinations(self.bits, n)]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def bit_counts(distinct: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and for each pair of bits the rows that set both, over all fingerprints; 4,097 numbers reach the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += len(bits)
            both += np.rint(bits.T @ bits).astype(np.int64)
        cells = np.append(both.ravel(), total)
        yield pa.RecordBatch.from_arrays([pa.array(range(len(cells)), pa.int32()), pa.array(cells)], ["cell", "n"])

    summed = distinct.select("fp").mapInArrow(run, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    cells = np.zeros(BITS * BITS + 1, np.int64)
    for row in summed.collect():
        cells[row["cell"]] = row["n"]
    return int(cells[-1]), cells[:-1].reshape(BITS, BITS)


def group_bits(total: int, both: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """All bits in ``parts`` groups of about equal width, correlated bits together.

    Each group starts with the most correlated pair left and takes the bit with the highest mean correlation to
    it. Correlation gathered in one group lets the other groups tell fingerprints apart.
    """
    share = np.diag(both) / max(total, 1)
    spread = np.sqrt(np.outer(share * (1 - share), share * (1 - share)))
    covariance = both / max(total, 1) - np.outer(share, share)
    tie = np.abs(np.divide(covariance, spread, out=np.zeros_like(covariance), where=spread > 0))
    left, groups = list(range(BITS)), []
    for part in range(parts):
        width = len(left) // (parts - part)
        group = list(max(combinations(left, 2), key=lambda pair: tie[pair])) if width > 1 else left[:1]
        while len(group) < width:
            group.append(max((b for b in left if b not in group), key=lambda b: tie[b, group].mean()))
        left = [b for b in left if b not in group]
        groups.append(tuple(sorted(group)))
    return groups


def allocate(costs: list[list[float]], distance: int) -> tuple[float, list[int]]:
    """Thresholds of least total cost by dynamic programming; ``costs[i][t + 1]`` is what part i costs at t.

    If two fingerprints differ in at most ``distance`` bits, and thresholds t_i satisfy
    ``sum(t_i + 1) = distance + 1``, some part differs in at most t_i bits. So the thresholds share
    ``distance + 1`` units, a part of threshold -1 taking none.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost in costs:
        grown: dict[int, tuple[float, list[int]]] = {}
        for used, (sofar, chosen) in best.items():
            for units in range(min(distance + 1 - used, len(cost) - 1) + 1):
                total = sofar + cost[units]
                if used + units not in grown or total < grown[used + units][0]:
                    grown[used + units] = (total, [*chosen, units - 1])
        best = grown
    return best[distance + 1]


def plan_parts(distinct: DataFrame, distance: int = DISTANCE) -> list[Part]:
    """Groups of bits and thresholds for these fingerprints, from counts over all of them.

    The pairs that share a part's bits are counted exactly; for thresholds above zero they are scaled by the
    odds that bits differ, from their counts. Divisions in two to ``distance + 1`` parts compete.
    """
    total, both = bit_counts(distinct)
    divisions = [group_bits(total, both, parts) for parts in range(2, distance + 2)]
    masks = [(d, i, Part(bits, 0).mask) for d, division in enumerate(divisions) for i, bits in enumerate(division)]
    cells = F.array(*[F.struct(F.lit(d * BITS + i).alias("part"), F.lit(m).cast("long").alias("mask")) for d, i, m in masks])
    n = F.col("n").cast("double")
    shared = (
        distinct.select("fp", F.explode(cells).alias("c"))
        .groupBy(F.col("c.part").alias("part"), F.col("fp").bitwiseAND(F.col("c.mask")).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("part")
        .agg(F.sum(n * (n - 1) / 2).alias("pairs"))
    )
    pairs = {r["part"]: r["pairs"] for r in shared.collect()}
    share = np.diag(both) / max(total, 1)
    differ = np.clip(2 * share * (1 - share), 1e-6, 0.5)
    odds = differ / (1 - differ)
    plans = []
    for d, division in enumerate(divisions):
        costs = []
        for i, bits in enumerate(division):
            ways, probes, cost = np.zeros(distance + 1), 0, [0.0]
            ways[0] = 1.0  # elementary symmetric sums of the odds
            for b in bits:
                ways[1:] += ways[:-1] * odds[b]
            for t in range(distance + 1):
                probes += sum(1 for _ in combinations(bits, t))
                cost.append(pairs.get(d * BITS + i, 0.0) * ways[: t + 1].sum() + PROBE_COST * probes * total)
            costs.append(cost)
        cost, thresholds = allocate(costs, distance)
        plans.append((cost, [Part(bits, t) for bits, t in zip(division, thresholds, strict=True)]))
    return min(plans, key=lambda x: x[0])[1]


# ---- links ----------------------------------------------------------------


def _forest(values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, int]]:
    """Links that connect what is within ``distance`` directly or over others: each value meets only those
    not reached yet, so a dense bucket costs little more than its size."""
    left = values
    while len(left) > 1:
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            near = np.bitwise_count(left ^ frontier[-1]) <= distance
            base = frontier.pop()
            if near.any():
                reached, left = left[near], left[~near]
                yield reached, base
                frontier.extend(reached)


def _bucket_links(buckets: np.ndarray, values: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within buckets; ``buckets`` numbers them in ascending order."""
    starts = np.flatnonzero(np.r_[True, buckets[1:] != buckets[:-1]])
    sizes = np.diff(np.r_[starts, len(buckets)])
    wide = np.repeat(sizes > SIDE_BY_SIDE, sizes)
    us, vs = [], []
    some, of = values[~wide], buckets[~wide]
    for step in range(1, min(SIDE_BY_SIDE, len(some))):
        near = (of[step:] == of[:-step]) & (np.bitwise_count(some[step:] ^ some[:-step]) <= distance)
        if not (of[step:] == of[:-step]).any():
            break
        us.append(some[step:][near])
        vs.append(some[:-step][near])
    for start, size in zip(starts[sizes > SIDE_BY_SIDE], sizes[sizes > SIDE_BY_SIDE], strict=True):
        for reached, base in _forest(values[start : start + size], distance):
            us.append(reached)
            vs.append(np.full(len(reached), base, values.dtype))
    empty = [np.empty(0, values.dtype)]
    return np.concatenate(us or empty), np.concatenate(vs or empty)


def links(distinct: DataFrame, distance: int = DISTANCE, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Pairs ``(u, v)`` of distinct fingerprints within ``distance`` bits, enough to connect all such pairs.

    Every fingerprint goes to the buckets that the parts of :func:`plan_parts` name: its own value and the
    values within the part's threshold. Any two within ``distance`` meet in a bucket; what meets is verified. A
    bucket over ``bucket_rows`` is dealt into parts and every pair of parts is compared by itself, so no task
    holds more than two parts.
    """
    parts = plan_parts(distinct, distance)
    probes = [(i, p.mask, f) for i, p in enumerate(parts) for f in p.flips()]
    fields = [(F.lit(i), F.lit(m).cast("long"), F.lit(f).cast("long")) for i, m, f in probes]
    probe = F.array(*[F.struct(i.alias("part"), m.alias("mask"), f.alias("flip")) for i, m, f in fields])
    keyed = distinct.select("fp", F.explode(probe).alias("p")).select(
        "fp",
        F.col("p.part").alias("part"),
        F.col("fp").bitwiseXOR(F.col("p.flip")).bitwiseAND(F.col("p.mask")).alias("value"),
        (F.col("p.flip") == 0).alias("own"),
    )
    sizes = (
        keyed.groupBy("part", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or("own").alias("probed"))
        .where((F.col("n") > 1) & F.col("probed"))
        .select("part", "value", F.ceil(F.col("n") / bucket_rows).cast("int").alias("pieces"))
    )
    mine = F.pmod(F.xxhash64("fp"), F.col("pieces")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("pieces") - 1))
    met = (
        keyed.join(sizes, ["part", "value"])
        .withColumn("mine", mine)
        .withColumn("other", other)
        .select("part", "value", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b"), "fp")
    )
    bucket = ["part", "value", "a", "b"]
    sorted_rows = met.repartition(*bucket).sortWithinPartitions(*bucket)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] | None = None  # the bucket that may go on in the next batch
        for batch in _and_end(batches):
            ended = batch is None
            got = [] if ended else [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if kept is not None:
                got = kept if ended else [np.concatenate(x) for x in zip(kept, got, strict=True)]
            kept = None
            if not got or not len(got[0]):
                continue
            new = np.zeros(len(got[0]), bool)
            for key in got[:4]:
                new[1:] |= key[1:] != key[:-1]
            if not ended:
                last = int(np.flatnonzero(new)[-1]) if new.any() else 0
                kept, got, new = [x[last:] for x in got], [x[:last] for x in got], new[:last]
                if not last:
                    continue
            us, vs = _bucket_links(np.cumsum(new), got[4].astype(np.uint64), distance)
            yield pa.RecordBatch.from_arrays([pa.array(us.view(np.int64)), pa.array(vs.view(np.int64))], ["u", "v"])

    return sorted_rows.mapInArrow(run, "u long, v long")


def _and_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


# ---- documents ------------------------------------------------------------


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """``doc_id``, ``mark``, ``fp``, ``component_id`` and the component's ``root`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over fingerprints that differ in at most ``distance``
    bits, the row's own included; NULL ids are passed over, and a component of NULL ids has NULL. Equal
    fingerprints are one node, so copies cost nothing beyond a count. Repeated rows and ids are rows like any
    other. An empty table gives an empty result. Other columns of ``docs`` are not read.
    """
    rows = stored(fingerprints(docs, doc_id, text), "fingerprints")
    distinct = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    stars = connected(links(distinct, distance))
    rooted = distinct.join(stars.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    component = rooted.join(lowest, "root").select("fp", "component_id", "root")
    return rows.join(component, "fp").select("doc_id", "mark", "fp", "component_id", "root")


def hex_of(fp: str = "fp") -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lpad(F.lower(F.hex(F.col(fp))), 16, "0")


def drop_near_copies(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", grouped: Callable[..., DataFrame] = near_groups
) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one whose id names it, all columns as they were.

    If several rows have that id, one with the smallest hash of id and text stays. Only the keys of dropped rows travel.
    """
    groups = stored(grouped(docs, doc_id, text), "near")
    named = F.col("doc_id").eqNullSafe(F.col("component_id"))
    # as many rows as repeat the component's id
    order = Window.partitionBy("root").orderBy("mark")
    ranked = groups.where(named).select("doc_id", "mark", F.rank().over(order).alias("_r"), F.row_number().over(order).alias("_n"))
    key, value, mark = (fresh(docs, n) for n in ("_drop_id", "_drop_mark", "_mark"))
    names = [F.col("doc_id").alias(key), F.col("mark").alias(value)]
    gone = groups.where(~named).select(*names).unionByName(ranked.where("_r > 1").select(*names)).distinct()
    twins = ranked.where("_r = 1 and _n > 1").select(*names).distinct()
    keyed = docs.withColumn(mark, text_hash(doc_id, text))
    return without(keyed, stored(gone, "dropped"), stored(twins, "twins"), [(doc_id, key), (mark, value)]).drop(mark)
