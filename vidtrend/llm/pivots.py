"""Centroid clustering over a LAESA pivot table.

Vectors become integers, floor(64 x) of every component.  Their distances to a few
fixed pivots are computed and stored once, beside the vectors.  In every round the
centroids' distances to the pivots bound their distance to a vector from below by
the triangle inequality, |d(v, p) - d(c, p)| <= d(v, c), without touching the
vector.  A vector is compared with the centroid of the smallest bound, then with
those centroids whose bound does not exceed that distance; these survivors receive
exact integer distances.  The bound is lowered by more than its rounding, so ties
are all seen; they go to the smaller number.

A round is one pass over the stored table: tasks add up their vectors per centroid,
Spark adds the tasks' sums, and the driver gets centroids x components sums, from
which it takes exact integer means.  Pivots and centroids are what every task gets,
both fixed numbers of vectors.

Defined results: vectors that are null, of another length, or hold null or
non-finite components take no part.  Every other row is a vector of its own, equal
ids included: rows with equal ids are dealt as starting centroids in the order of their vectors,
and a null id counts as the text ''.  Fewer vectors than centroids: as many
centroids as vectors.  An empty table gives an empty result.  Components beyond
2^21 in size would not leave exact 64-bit distances: they raise an error.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, release_worker_state

#: Of an integer component: 64 squared differences of twice this are below 2^63.
LARGEST = 1 << 27


def integers(vector: Column, scale: int) -> Column:
    def floored(x):
        y = F.floor(x.cast("double") * scale)
        too_large = F.raise_error(F.lit(f"a component times {scale} is beyond {LARGEST}"))
        return F.when(F.abs(x.cast("double") * scale) <= LARGEST, y).otherwise(too_large.cast("long")).cast("int")
    return F.transform(vector, floored)


def usable(vector: Column, dimensions: int) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def smallest(vectors: DataFrame, count: int, salt: str, rows: int) -> np.ndarray:
    """The ``count`` vectors with the smallest sha256 of ``salt:id``, in that order.

    Only hashes below a threshold that lets about eight times as many pass are
    sorted; the threshold rises while too few do."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    share = min(1.0, 8 * count / max(rows, 1))
    while True:
        limit = f"{int(share * 16**12):012x}"
        low = vectors.select("v", key.alias("key")).where((F.substring("key", 1, 12) < limit) if share < 1 else F.lit(True))
        found = low.orderBy("key", "v").limit(count).collect()
        if len(found) == count or share >= 1:
            return np.array([r.v for r in found], dtype=np.int64)
        share = min(1.0, share * 8)


def _matrix(column: pa.ListArray, dimensions: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions).astype(np.int64)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances between the rows of a and of b."""
    return np.stack([((a - row) ** 2).sum(axis=1) for row in b], axis=1) if len(b) else np.zeros((len(a), 0), np.int64)


def nearest(vectors: np.ndarray, to_pivots: np.ndarray, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Number and squared distance of every vector's nearest centroid, and how many distances that took."""
    d, c = np.sqrt(to_pivots.astype(np.float64)), np.sqrt(squared(centroids, pivots).astype(np.float64))
    bound = np.zeros((len(vectors), len(centroids)))
    for k in range(len(pivots)):
        np.maximum(bound, np.abs(d[:, k, None] - c[None, :, k]), out=bound)
    # a double's relative rounding of the roots, and of their difference, is far below this
    bound -= 1e-9 * (d.max(axis=1, initial=0)[:, None] + c.max(axis=1, initial=0)[None, :]) + 1e-9
    least = np.clip(bound, 0, None) ** 2
    rows = np.arange(len(vectors))
    first = least.argmin(axis=1)
    exact = np.full(bound.shape, np.iinfo(np.int64).max)
    exact[rows, first] = ((vectors - centroids[first]) ** 2).sum(axis=1)
    survives = least <= exact[rows, first][:, None]
    survives[rows, first] = False
    for k, centroid in enumerate(centroids):
        own = survives[:, k]
        exact[own, k] = ((vectors[own] - centroid) ** 2).sum(axis=1)
    cluster = exact.argmin(axis=1)
    return cluster, exact[rows, cluster], len(rows) + int(survives.sum())


def nearest_of(batch: pa.RecordBatch, centroids: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The vectors of a batch of the table, and the number and distance of their nearest centroids."""
    v = _matrix(batch["v"], centroids.shape[1])
    return v, *nearest(v, _matrix(batch["to_pivots"], len(pivots)), centroids, pivots)[:2]


class PivotTable:
    """Vectors with their distances to the pivots, stored once."""

    def __init__(self, vectors: DataFrame, dimensions: int, pivots: int, scale: int) -> None:
        self.dimensions = dimensions
        clean = vectors.where(usable(F.col("vector"), dimensions)).select("vec_id", integers(F.col("vector"), scale).alias("v"))
        self.rows = clean.count()
        self.pivots = chosen = smallest(clean, pivots, "pivot", self.rows)

        def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_worker_state()
            for batch in batches:
                far = squared(_matrix(batch["v"], dimensions), chosen)
                lists = pa.ListArray.from_arrays(np.arange(len(far) + 1, dtype=np.int32) * far.shape[1], far.ravel())
                yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["v"], lists], ["vec_id", "v", "to_pivots"])

        id_type = clean.schema["vec_id"].dataType.simpleString()
        self.table = keep(clean.mapInArrow(measure, f"vec_id {id_type}, v array<int>, to_pivots array<long>"), "pivots")

    def means(self, centroids: np.ndarray) -> np.ndarray:
        """The centroids after one round: floor of the mean of their vectors; empty ones stay."""
        dimensions, pivots = self.dimensions, self.pivots

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_worker_state()
            sums = np.zeros((len(centroids), dimensions + 1), np.int64)
            for batch in batches:
                v, cluster, _ = nearest_of(batch, centroids, pivots)
                np.add.at(sums, cluster, np.column_stack([v, np.ones(len(v), np.int64)]))
            c, d = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(c), pa.array(d), pa.array(sums[c, d])], ["cluster", "component", "total"])

        sums = np.zeros((len(centroids), dimensions + 1), object)
        for r in (self.table.mapInArrow(add, "cluster long, component long, total long").groupBy("cluster", "component")
                  .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()):
            sums[r.cluster, r.component] = int(r.total)
        return np.array([[x // row[-1] for x in row[:-1]] if row[-1] else old for row, old in zip(sums, centroids.tolist())], dtype=np.int64)

    def assign(self, centroids: np.ndarray) -> DataFrame:
        pivots = self.pivots

        def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            release_worker_state()
            for batch in batches:
                _, cluster, distance = nearest_of(batch, centroids, pivots)
                yield pa.RecordBatch.from_arrays([batch["vec_id"], pa.array(cluster, pa.int32()), pa.array(distance)], ["vec_id", "cluster", "distance"])

        id_type = self.table.schema["vec_id"].dataType.simpleString()
        return self.table.mapInArrow(label, f"vec_id {id_type}, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 16, rounds: int = 3, dimensions: int = 64, scale: int = 64, salt: str = "1",
            pivots: int = 16) -> DataFrame:
    """``vectors`` (vec_id, vector) -> vec_id, cluster, distance (squared), cluster_inertia,
    inertia, centroid (array of its integers) and centroid_sha256."""
    held = PivotTable(vectors, dimensions, pivots, scale)
    spark = vectors.sparkSession
    centroids = smallest(held.table, k, salt, held.rows)
    if not len(centroids):
        return held.assign(np.zeros((1, dimensions), np.int64)).limit(0).select(
            "*", *[F.lit(None).cast(t).alias(c) for c, t in (("cluster_inertia", "long"), ("inertia", "long"), ("centroid", "array<long>"), ("centroid_sha256", "string"))])
    for _ in range(rounds):
        centroids = held.means(centroids)
    found = keep(held.assign(centroids), "clusters")
    inertia = {r.cluster: int(r.total) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}
    total = sum(inertia.values())
    of_cluster = spark.createDataFrame(
        [(c, n, total, centroids[c].tolist(), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, n in sorted(inertia.items())],
        "cluster int, cluster_inertia long, inertia long, centroid array<long>, centroid_sha256 string")
    # a row per centroid, k at most
    return found.join(F.broadcast(of_cluster), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid", "centroid_sha256")
