"""Centroid clustering by a tournament of bisectors: linear sign tests eliminate all centroids but the nearest."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellmart.llm.common import stored
from cellmart.llm.vectors import EXACT, blocks, cell_sums, integers, largest, longs, moved, numbers

CLUSTERS = 16
ROUNDS = 3
DIMS = 64
SCALE = 64.0
SEED = 1
# bytes of normals that are sent to every task
NORMAL_BYTES = 64 * 1024 * 1024


class Bisectors:
    """Integer normals and thresholds of all pairs of centroids ``a < b``.

    ``2 (b - a) . x <= |b|^2 - |a|^2`` where ``x`` is as near to ``a`` as to ``b`` or nearer; equality is a tie, which ``a``,
    the smaller number, wins.
    """

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids = centroids
        a, b = np.triu_indices(len(centroids), 1)
        whole = centroids.astype(object)
        square = (whole * whole).sum(1) if len(whole) else np.zeros(0, object)
        self.normals = 2 * (whole[b] - whole[a])
        self.thresholds = square[b] - square[a]
        # doubles hold them as long as all products stay below 2^53
        reach = 4 * centroids.shape[1] * (largest(centroids) + 1) ** 2
        self.exact = reach < EXACT
        if self.exact:
            self.normals, self.thresholds = self.normals.astype(np.float64), self.thresholds.astype(np.float64)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest centroid and the squared distance to it, for each row of longs.

        The champion so far meets each later number once: ``k - 1`` sign tests a row. It is always the smaller
        number, so a zero leaves it in place.
        """
        k, dims = self.centroids.shape
        exact = self.exact and 4 * dims * (largest(x) + largest(self.centroids) + 1) ** 2 < EXACT
        given = numbers(x, exact)
        normals, thresholds = (self.normals, self.thresholds) if exact or not self.exact else (self.normals.astype(np.int64).astype(object), self.thresholds)
        champion = np.zeros(len(x), np.int64)
        for b in range(1, k):
            pair = champion * (2 * k - champion - 1) // 2 + b - champion - 1
            side = (given * normals[pair]).sum(1)
            champion[(side > thresholds[pair]).astype(bool)] = b
        apart = given - numbers(self.centroids, exact)[champion]
        return champion, longs((apart * apart).sum(1))


def seeds(rows: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors with the smallest SHA-256 of ``seed:vec_id``, in that order; equal ids by their components."""
    named = rows.where(F.col("vec_id").isNotNull()).withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256))
    first = named.orderBy("h", "v").limit(clusters).select("v").collect()
    return np.array([r.v for r in first], np.int64) if first else np.zeros((0, 0), np.int64)


def cluster(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    clusters: int = CLUSTERS,
    rounds: int = ROUNDS,
    dims: int = DIMS,
    scale: float = SCALE,
    seed: int = SEED,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` per vector of exactly ``dims`` components.

    Components are the integers floor(scale * x). Each round sums the vectors of a cluster in their tasks and moves its
    centroid to the exact floor of the mean; clusters without vectors stay. Distances are squared and exact; ties go to the
    smaller number. Centroids, their normals (``clusters^2 * dims / 2``, at most 64 MB) and a row per cluster and component
    are all that the driver sees.

    Vectors that are NULL, of another length, or hold NULL or non-finite components take no part. Rows without an id
    are clustered but are no start; repeated rows count each. With fewer vectors than clusters there are as many clusters as
    vectors with an id; without any the result is empty. Components beyond 2^62, and distances beyond a long, stop the job.
    """
    if 4 * clusters * (clusters - 1) * dims > NORMAL_BYTES:
        raise ValueError(f"the bisectors of {clusters} centroids take over {NORMAL_BYTES} bytes")
    rows = integers(vectors, scale, embedding, vec_id=vec_id)
    rows = stored(rows.where(F.size("v") == dims), "vectors")
    centroids = seeds(rows, clusters, seed)
    kinds = [rows.schema["vec_id"], *T.StructType.fromDDL("cluster int, distance long").fields]
    spark = rows.sparkSession
    if not len(centroids):
        more = T.StructType.fromDDL("cluster_inertia long, inertia long, centroid_sha256 string").fields
        return spark.createDataFrame([], T.StructType([*kinds, *more]))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(Bisectors(centroids))

        def cells(x: np.ndarray, shared=shared) -> Iterator[tuple[np.ndarray, np.ndarray]]:
            yield shared.value.nearest(x)[0], x

        centroids = moved(centroids, *cell_sums(rows, dims, cells, len(centroids), dims))
    shared = spark.sparkContext.broadcast(Bisectors(centroids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in blocks(batch, "v", dims):
                number, distance = shared.value.nearest(x)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

    assigned = stored(rows.mapInArrow(run, T.StructType(kinds)), "assigned")
    inertia = dict(assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)"))).collect())
    total = int(sum(inertia.values()))
    names = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    facts = [(i, int(inertia.get(i, 0)), total, name) for i, name in enumerate(names)]
    facts = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    columns = ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return assigned.join(F.broadcast(facts), "cluster").select(*columns)
