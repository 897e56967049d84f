from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidtrend.llm import pivots, queries

SCHEMA = "vec_id long, vector array<float>"


def brute(rows, k=16, rounds=3, dimensions=64, scale=64):
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    centroids = [v for _, v in start]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for n in range(len(centroids)):
            mine = [v for (_, v), (_, c) in zip(kept, own) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    own = assign()
    inertia = [sum(d for d, c in own if c == n) for n in range(len(centroids))]
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(((i, c, d, inertia[c], sum(inertia), digest[c]) for (i, _), (d, c) in zip(kept, own)), key=str)


def result(df):
    return sorted(((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256) for r in df.collect()), key=str)


def rows_of(n, dimensions, seed, step=0.25):
    rng = random.Random(seed)
    return [(k, [round(rng.gauss(0, 1) / step) * step for _ in range(dimensions)]) for k in range(n)]


def test_many_ties_nulls_and_odd_vectors(spark):
    rows = rows_of(120, 2, 1, step=1.0) + rows_of(20, 2, 1, step=1.0)
    rows += [(500, None), (501, []), (502, [1.0]), (503, [1.0, None]), (504, [float("nan"), 0.0]), (505, [float("inf"), 0.0]), (506, [0.0, 0.0]), (None, [2.0, 1.0]), (None, [-2.0, 1.0])]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    for k, n in ((5, 1), (7, 3), (16, 0)):
        assert result(pivots.cluster(df, k=k, rounds=n, dimensions=2, scale=1, pivots=3)) == brute(rows, k, n, 2, 1)


@pytest.mark.parametrize("n", [1, 3, 15])
def test_fewer_vectors_than_centroids(spark, n):
    rows = rows_of(n, 64, n)
    assert result(pivots.cluster(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_whole_table(spark, tiny):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{tiny}/embeddings.parquet").collect()]
    assert result(queries.op13_clusters(spark, tiny)) == brute(rows)


def test_empty_and_unusable_tables(spark):
    for rows in ([], [(1, None), (2, [1.0])]):
        got = pivots.cluster(spark.createDataFrame(rows, SCHEMA))
        assert got.count() == 0 and set(got.columns) >= {"cluster_inertia", "inertia", "centroid_sha256"}


def test_largest_components_and_those_beyond(spark):
    edge = [(k, [float(s << 21)] * 63 + [float(k)]) for k, s in enumerate([1, -1, 1, -1])]
    assert result(pivots.cluster(spark.createDataFrame(edge, SCHEMA), k=2, rounds=1)) == brute(edge, 2, 1)
    beyond = spark.createDataFrame([(1, [1e30] * 64)], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        pivots.cluster(beyond).collect()


def test_bounds_spare_distances_and_lose_no_tie():
    rng = np.random.default_rng(5)
    centres = rng.integers(-500, 500, (16, 64))
    vectors = centres[rng.integers(0, 16, 3000)] + rng.integers(-9, 10, (3000, 64))
    chosen = vectors[:16]
    cluster, distance, taken = pivots.nearest(vectors, pivots.squared(vectors, chosen), centres, chosen)
    every = pivots.squared(vectors, centres)
    assert (cluster == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()
    assert taken < every.size / 2
    same = np.zeros((4, 64), np.int64)
    assert pivots.nearest(vectors, pivots.squared(vectors, chosen), same, chosen)[0].max() == 0


def test_other_columns_are_not_read(spark):
    rows = rows_of(30, 64, 2)
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({"v": F.lit("x"), "key": F.lit(1), "cluster": F.lit(2)})
    assert result(pivots.cluster(odd)) == brute(rows)
