from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from vidtrend.llm import ann
from vidtrend.llm.queries import op3_nearest

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, vector array<float>"


def brute(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    matrix = np.array([v for _, v in rows], dtype=float)
    out = {}
    for q, v in queries:
        score = np.einsum("ij,j->i", matrix, np.array(v, dtype=float))
        order = np.lexsort((ids, -score))
        out[q] = [(int(ids[j]), float(score[j])) for j in order if ids[j] != q][:k]
    return out


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 20 == 0], 20)
    got: dict = {}
    for r in sorted(op3_nearest(spark, SF).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    vectors = {i: np.array(v, dtype=float) for i, v in rows}
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    for q, near in got.items():
        assert all(abs(s - vectors[q] @ vectors[i]) < 1e-12 for i, s in near)
        assert near == sorted(near, key=lambda x: (-x[1], x[0]))
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.9


def test_recall_of_the_forest_itself(spark):
    """On tables of 500 and 2,000 rows queries look at a part of them, and find nine tenths."""
    for sf in (SF, "/root/testdata/sf0.1"):
        rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
        ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], dtype=float)
        asked = np.flatnonzero(ids % 20 == 0)
        looked, found = [], []
        want = brute(rows, [rows[j] for j in asked], 20)
        for j, near in zip(asked, ann.Forest(vectors, 32, 32, 3).candidates(vectors[asked], int(np.ceil(0.7 * len(rows))))):
            looked.append(len(near) / len(rows))
            found.append(len({i for i, _ in want[ids[j]]} & set(ids[near].tolist())) / 20)
        assert max(looked) < 0.8 and np.mean(found) >= 0.9


def test_repeated_rows_and_ids(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [3.0, 0.0]), (2, [2.0, 1.0]), (3, [0.0, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    queries = spark.createDataFrame([(9, [1.0, 0.0]), (9, [1.0, 0.0]), (9, [0.0, 1.0])], "query_id long, vector array<float>")
    got = [(r["rank"], r.vec_id, r.score) for r in ann.search(df, queries, k=6, share=1.0).orderBy("rank").collect()]
    assert [x[1:] for x in got] == [(3, 5.0), (1, 3.0), (2, 2.0), (1, 1.0), (2, 1.0), (1, 0.0)] and [x[0] for x in got] == [1, 2, 3, 4, 5, 6]


def test_whole_share_is_exact_over_shards_and_blocks(spark):
    rng = np.random.default_rng(6)
    rows = [(k, [float(x) for x in np.float32(rng.standard_normal(8) * (1 + k % 5))]) for k in range(300)]
    rows += [(1000 + k, rows[3][1]) for k in range(60)]  # equal vectors: ties go to the smaller id
    df = spark.createDataFrame(rows, SCHEMA)
    queries = df.where("vec_id % 20 = 0").withColumnRenamed("vec_id", "query_id")
    got: dict = {}
    for r in sorted(ann.search(df, queries, k=7, share=1.0, shard_rows=50, block_queries=4).collect(), key=lambda r: (r.query_id, r["rank"])):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert got == brute(rows, [r for r in rows if r[0] % 20 == 0], 7)


def test_vectors_that_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 0.0]),
            (6, [1.0, None]), (7, []), (8, [1.0, 0.0, 0.0]), (None, [1.0, 1.0]), (20, [0.0, 0.0]), (40, [-1.0, 3.0])]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("shard", F.lit("x")).withColumn("rank", F.lit(1))
    queries = df.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "vector")
    got = sorted(tuple(r) for r in ann.search(df, queries).collect())
    assert got == [(0, 1, 1, 2.0), (0, 2, 40, -1.0), (40, 1, 0, -1.0), (40, 2, 1, -2.0)]
    assert ann.search(df.limit(0), queries).count() == 0 and ann.search(df, queries.limit(0)).count() == 0
