"""Near duplicates by the Jaccard similarity of word shingles: SimHash fingerprints and MinHash bands name candidates, the exact similarity decides."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import col, fresh, matched, stored, text_hash
from cellmart.llm.components import connected
from cellmart.llm.simhash import drop_near_copies, fingerprint, links

SHINGLE = 5
SIMILARITY = 0.8
# two texts meet if all hashes of a band agree: at similarity 0.8, all bands miss in 7 pairs of 10,000
BANDS = 24
BAND_HASHES = 6
SEED = 42
# bits of a set's parity
PARITY_BITS = 1024
# turns in which every node meets one of each of its buckets
TURNS = 2
# sizes of sets within one class differ by at most this, as a logarithm
LENGTH_STEP = 0.05
# shingles that meet all hash functions at a time
BLOCK = 1 << 12
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_ODD = np.uint64(0xD6E8FEB86659FD93)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return x ^ (x >> np.uint64(32))


_FUNCTIONS = _mix(np.arange(1, BANDS * BAND_HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """Hashes of the distinct runs of ``size`` words, ascending; a shorter text is one run, a text without words has none."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w, SEED) for w in words), np.uint64, len(words))
    runs = max(len(words) - size + 1, 1)
    found = np.zeros(runs, np.uint64)
    for k in range(min(size, len(words))):
        found = _mix(found + hashes[k : k + runs])
    return np.unique(found)


def bands(found: np.ndarray) -> list[int]:
    """A hash per band of the smallest values that the band's functions give the shingles."""
    low = np.full(len(_FUNCTIONS), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(found), BLOCK):
        np.minimum(low, (found[at : at + BLOCK, None] * _FUNCTIONS).min(0), out=low)
    rows = low.reshape(BANDS, BAND_HASHES)
    return [_signed(xxhash.xxh64_intdigest(row.tobytes(), i)) for i, row in enumerate(rows)]


def parity(found: np.ndarray) -> np.ndarray:
    """``PARITY_BITS`` bits, each telling whether an odd number of the shingles fall on it, as longs.

    A shingle that only one of two sets has turns one bit over: the sets differ in at least as many shingles as their bits do.
    """
    odd = np.bincount((found >> np.uint64(64 - PARITY_BITS.bit_length() + 1)).astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _may_be_similar(similarity: float) -> Column:
    """Whether the sizes and parities of a node and its ``other_`` allow the similarity; false only if it is out of reach."""
    near = F.least("n", "other_n") >= F.lit(similarity) * F.greatest("n", "other_n") - 1e-9
    apart = reduce(add, [F.bit_count(F.get("parity", i).bitwiseXOR(F.get("other_parity", i))) for i in range(PARITY_BITS // 64)])
    return near & (apart * (1 + similarity) <= (1 - similarity) * (F.col("n") + F.col("other_n")) + 1e-6)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``mark``, ``node`` (64 bits of the set of shingles), ``n`` (shingles in it), ``fp`` (the SimHash fingerprint over shingles of this size),
    ``bands`` and ``parity`` per row."""
    given = docs.select(col(doc_id).alias("doc_id"), text_hash(doc_id, text).alias("mark"), col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sizes, keys, odd, prints = [], [], [], [], []
            for value in batch.column(2):
                found = shingles(value.as_py(), shingle)
                nodes.append(_signed(xxhash.xxh64_intdigest(found.tobytes(), SEED)))
                sizes.append(len(found))
                keys.append(bands(found) if len(found) else [])
                odd.append(parity(found))
                prints.append(fingerprint(value.as_py(), shingle))
            lists = [pa.array(x, pa.list_(pa.int64())) for x in (keys, odd)]
            longs = [pa.array(x, pa.int64()) for x in (nodes, sizes, prints)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *longs, *lists], ["doc_id", "mark", "node", "n", "fp", "bands", "parity"])

    kinds = [T.StructField(n, given.schema[n].dataType) for n in ("doc_id", "mark")]
    return given.mapInArrow(run, T.StructType([*kinds, *T.StructType.fromDDL("node long, n long, fp long, bands array<long>, parity array<long>").fields]))


def _sets(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, shingle: int) -> DataFrame:
    """``node`` and its shingles as an array, from the text of one row of each."""
    key, mark, own, name = (fresh(docs, n) for n in ("_node_id", "_node_mark", "_mark", "_node"))
    asked = nodes.select(F.col("row.doc_id").alias(key), F.col("row.mark").alias(mark), F.col("node").alias(name))
    texts = docs.select(col(doc_id), col(text)).withColumn(own, text_hash(doc_id, text))
    given = matched(texts, stored(asked, "asked"), [(doc_id, key), (own, mark)], "inner").select(col(name), col(text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingles(x.as_py(), shingle).view(np.int64) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.list_(pa.int64()))], ["node", "shingles"])

    # rows that repeat id and text have the same set
    return given.mapInArrow(run, "node long, shingles array<long>").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Those of ``pairs(u, v)`` whose sets of shingles are similar enough."""
    both = pairs
    for side in ("u", "v"):
        both = both.join(sets.select(F.col("node").alias(side), F.col("shingles").alias(f"{side}_set")), side)
    same = F.size(F.array_intersect("u_set", "v_set"))
    union = F.size("u_set") + F.size("v_set") - same
    return both.where(same / union >= similarity - 1e-12).select("u", "v")


def _rooted(members: DataFrame, stars: DataFrame | None) -> DataFrame:
    """``members`` with the ``root`` of their component."""
    if stars is None:
        return members.withColumn("root", F.col("node"))
    rooted = members.join(stars.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").drop("of")
    return stored(rooted.withColumn("root", F.coalesce("root", "node")), "rooted")


def _met(rooted: DataFrame, turn: int, similarity: float) -> DataFrame:
    """Every node with one node of each of its buckets, where the two are not connected yet.

    First the same node for as many buckets as have it, which connects most of a large group by few pairs; then one of each bucket's own.
    """
    order = F.xxhash64("node") if turn == 0 else F.xxhash64("node", "key", F.lit(turn))
    centre = rooted.groupBy("key").agg(
        F.min(F.struct(order.alias("h"), "node", "n", "root", "parity")).alias("c"),
        (F.min("root") < F.max("root")).alias("mixed"),
    )
    centre = centre.where("mixed").select("key", *[F.col(f"c.{c}").alias(f"other_{c}") for c in ("node", "n", "root", "parity")])
    # stored, so that the join is one of two tables and Spark splits a hot key
    met = rooted.join(stored(centre, "centres"), "key").where((F.col("root") != F.col("other_root")) & _may_be_similar(similarity))
    return met.select(F.least("node", "other_node").alias("u"), F.greatest("node", "other_node").alias("v")).distinct()


def fingerprint_pairs(nodes: DataFrame) -> DataFrame:
    """Pairs ``(u, v)`` of nodes that SimHash names: enough to connect all whose fingerprints are within its distance.

    Nodes of one fingerprint meet the smallest of them, and the smallest ones of linked fingerprints meet.
    """
    hashed = stored(nodes.where("n > 0").select("node", F.col("row.fp").alias("fp")), "fingerprints")
    distinct = stored(hashed.groupBy("fp").agg(F.min("node").alias("centre")), "distinct")
    same = hashed.join(distinct, "fp").where(F.col("node") != F.col("centre")).select(F.col("centre").alias("u"), F.col("node").alias("v"))
    near = links(distinct.select("fp"))
    for side in ("u", "v"):
        near = near.join(distinct.select(F.col("fp").alias(side), F.col("centre").alias(f"{side}_node")), side)
    pairs = same.unionByName(near.select(F.col("u_node").alias("u"), F.col("v_node").alias("v")))
    return pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()


def _length_class(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(LENGTH_STEP)).cast("int")


def _rest(rooted: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs left to verify: nodes of a bucket outside its largest component with the others of the bucket that they can be similar to.

    No pair can share more than ``free``, the shingles that any other node of the buckets left has too. At similarity ``t``
    that bounds the sizes that a node's partners can have: at most ``free * (1 + t) / t - n``. Copies with
    many words of their own so drop out one by one, not in pairs; the others are compared by bucket and class of size, and a pair is
    made, at the first band that it shares, only where the parities leave the similarity within reach.
    """
    by_root = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c")).groupBy("key").agg(
        F.max(F.struct("c", "root")).alias("most"), F.count(F.lit(1)).alias("roots")
    )
    mixed = stored(by_root.where("roots > 1").select("key", F.col("most.root").alias("main")), "mixed")
    left = stored(rooted.join(mixed, "key"), "left")
    asked = stored(left.select("node").distinct(), "asked")
    alone = sets.join(asked, "node", "left_semi").select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
    alone = alone.agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("own")).where("c = 1").groupBy("own").agg(F.count(F.lit(1)).alias("c"))
    facts = nodes.join(asked, "node", "left_semi").join(alone.withColumnRenamed("own", "node"), "node", "left")
    free = F.col("n") - F.coalesce("c", F.lit(0))
    high = F.least(F.col("n") / similarity, free * ((1 + similarity) / similarity) - F.col("n")) + 1e-6
    facts = facts.select("node", free.alias("free"), high.alias("high"), "bands").where(F.col("high") >= F.col("n") * similarity)
    sides = stored(left.join(facts, "node"), "sides")
    low = _length_class(F.ceil(F.col("n") * similarity - 1e-6))
    seekers = sides.where("root <> main").withColumn("class", F.explode(F.sequence(low, _length_class(F.floor("high")))))
    other = [F.col(c).alias(f"other_{c}") for c in ("node", "n", "root", "free", "high", "bands", "parity")]
    partners = sides.select("key", _length_class(F.col("n")).alias("class"), "main", *other)
    # two seekers meet once
    once = (F.col("other_root") == F.col("main")) | (F.col("node") < F.col("other_node"))
    sizes = (F.col("other_n") <= F.col("high")) & (F.col("n") <= F.col("other_high"))
    shared = F.least("free", "other_free") * (1 + similarity) >= similarity * (F.col("n") + F.col("other_n")) - 1e-6
    first = F.array_position(F.zip_with("bands", "other_bands", lambda a, b: a == b), F.lit(True)) == F.col("band") + 1
    met = seekers.drop("main").join(partners, ["key", "class"])
    met = met.where((F.col("root") != F.col("other_root")) & once & sizes & shared & _may_be_similar(similarity) & first)
    return met.select(F.least("node", "other_node").alias("u"), F.greatest("node", "other_node").alias("v")).distinct()


def components(
    members: DataFrame, nodes: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, named: DataFrame | None = None
) -> DataFrame:
    """``node, root`` of the components that all pairs of nodes with at least ``similarity`` that share a band make, and those of
    the pairs ``named`` that have it; roots have no row.

    The named pairs are verified first. ``members(key, band, node, n)`` are the nodes of each bucket. In each turn every node meets one node of each of its buckets,
    and what is verified is connected. Then the few nodes that are not
    connected to their bucket's largest component meet those of its nodes that they can be similar to (see :func:`_rest`), so a
    large group of near copies costs little more than its size, and no link that shares a band is left out.
    """
    stars, checked = None, named
    if named is not None:
        stars = connected(_verified(named, sets, similarity))
    for turn in range(TURNS + 1):
        rooted = _rooted(members, stars)
        pairs = _met(rooted, turn, similarity) if turn < TURNS else _rest(rooted, nodes, sets, similarity)
        if checked is not None:
            pairs = pairs.join(checked, ["u", "v"], "left_anti")
        pairs = stored(pairs, "pairs")
        linked = _verified(pairs, sets, similarity)
        if stars is not None:
            # what is connected already is a star: few rounds more
            linked = linked.unionByName(stars.select(F.col("node").alias("u"), F.col("root").alias("v")))
        stars = connected(linked)
        checked = pairs if checked is None else checked.unionByName(pairs)
    return stars


def similar_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    similarity: float = SIMILARITY,
) -> DataFrame:
    """``doc_id``, ``mark``, ``component_id`` and the component's ``root`` per row of ``docs``.

    ``component_id`` is the smallest id reachable over texts whose sets of ``shingle`` words in a row have a
    Jaccard similarity of at least ``similarity``, the row's own included; NULL ids are passed over, and a component of NULL
    ids has NULL. Candidates have SimHash fingerprints that few bits set apart, or share a band of MinHash values, which a pair at 0.8 fails to in 7 cases of 10,000, the more
    similar ones less often; every candidate is decided by its whole sets. Texts with equal sets, or without words, are one
    node. ASCII case and white space do not count. An empty table gives an empty result; other columns are not read.
    """
    rows = stored(signatures(docs, doc_id, text, shingle), "signatures")
    nodes = stored(
        rows.groupBy("node").agg(
            F.min("doc_id").alias("low"), F.min(F.struct("doc_id", "mark", "fp")).alias("row"), F.first("n").alias("n"), F.first("bands").alias("bands"),
            F.first("parity").alias("parity"),
        ),
        "nodes",
    )
    keyed = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    twice = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    members = keyed.join(twice, "key", "left_semi")
    members = stored(members.join(nodes.select("node", "parity"), "node"), "members")
    named = stored(fingerprint_pairs(nodes), "named")
    met = [members.select("node"), *[named.select(F.col(side).alias("node")) for side in ("u", "v")]]
    meeting = nodes.join(reduce(DataFrame.unionByName, met).distinct(), "node", "left_semi")
    sets = stored(_sets(docs, meeting, doc_id, text, shingle), "sets")
    stars = components(members, nodes, sets, similarity, named).withColumnRenamed("node", "of")
    rooted = nodes.join(stars, F.col("node") == F.col("of"), "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    component = rooted.join(lowest, "root").select("node", "component_id", "root")
    return rows.join(component, "node").select("doc_id", "mark", "component_id", "root")


def drop_similar(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of :func:`similar_groups`, chosen as by :func:`drop_near_copies`."""
    return drop_near_copies(docs, doc_id, text, similar_groups)
