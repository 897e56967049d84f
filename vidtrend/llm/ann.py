"""Approximate nearest neighbours by inner product with a hash-prefix forest.

A tree is the sorted array of long hash strings (signs of random projections) of
all its vectors.  A query descends every tree by binary search to the longest
prefix it matches, then ascends all trees together, one bit at a time, and takes
in every vector that shares that prefix in some tree, until it has the wanted
share of distinct candidates.  Candidates are scored exactly on the original
vectors in double precision.

The index is dealt by hash of the id into shards of about ``shard_rows`` vectors,
each with its own forest; queries come in blocks of about ``block_queries``.  One
task holds one shard and one block, whatever the input, and every shard answers a
query with its own nearest; the best of these are kept.  Equal vectors spread
over all shards.

Inner products become angles by one more coordinate, which fills every indexed
vector up to the largest norm of its shard.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part; vectors of another length than the query's are no
candidates; rows with a null id take no part; rows with the query's own id are no
candidates; equal scores go to the smaller id; an empty table gives no rows.  Rows of
the index with equal ids are candidates each for itself, equal rows once; queries with
equal ids are one query, ranked by the scores of all its vectors together.
Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidtrend.llm.common import small_batches


def usable(vector: Column) -> Column:
    """Whether a vector can be searched: finite throughout, and not zero."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


class Forest:
    """Sorted hash strings of ``bits`` bits for each of ``trees`` trees over rows of ``vectors``."""

    def __init__(self, vectors: np.ndarray, trees: int, bits: int, seed: int) -> None:
        self.bits, dim = bits, vectors.shape[1]
        self.planes = np.random.default_rng(seed).standard_normal((trees, dim + 1, bits))
        norms = np.sqrt((vectors ** 2).sum(axis=1))
        top = norms.max()
        lifted = np.column_stack((vectors / top, np.sqrt(np.maximum(0, 1 - (norms / top) ** 2))))
        codes = self._codes(lifted)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)

    def _codes(self, lifted: np.ndarray) -> np.ndarray:
        place = (np.uint64(1) << np.arange(self.bits, dtype=np.uint64)[::-1])
        return np.stack([((lifted @ p) > 0) @ place for p in self.planes]).astype(np.uint64)

    def candidates(self, queries: np.ndarray, wanted: int):
        """For each query the rows found by synchronous ascent: at least ``wanted``, or all."""
        lifted = np.column_stack((queries / np.sqrt((queries ** 2).sum(axis=1, keepdims=True)), np.zeros(len(queries))))
        codes = self._codes(lifted)
        trees, rows = self.order.shape
        # ranges of every tree at every prefix length, longest first
        low = np.empty((self.bits + 1, trees, len(queries)), dtype=np.int64)
        high = np.empty_like(low)
        for x in range(self.bits + 1):
            free = (np.uint64(1) << np.uint64(self.bits - x)) - np.uint64(1)
            for t in range(trees):
                low[x, t] = np.searchsorted(self.sorted[t], codes[t] & ~free)
                high[x, t] = np.searchsorted(self.sorted[t], codes[t] | free, "right")
        many = (high - low).sum(axis=1)
        for q in range(len(queries)):
            # the longest prefix at which all ranges together could hold enough
            x = int(np.flatnonzero(many[:, q] >= min(wanted, rows))[-1])
            found = np.zeros(rows, dtype=bool)
            for t in range(trees):
                found[self.order[t, low[x, t, q]:high[x, t, q]]] = True
            while x and np.count_nonzero(found) < wanted:
                # one bit up in tree after tree, until there are enough
                x -= 1
                for t in range(trees):
                    found[self.order[t, low[x, t, q]:high[x, t, q]]] = True
                    if np.count_nonzero(found) >= wanted:
                        break
            yield np.flatnonzero(found)


def search(index: DataFrame, queries: DataFrame, k: int = 20, trees: int = 32, bits: int = 32, share: float = 0.7,
           least: int | None = None, shard_rows: int = 8192, block_queries: int = 4096, seed: int = 3) -> DataFrame:
    """The ``k`` nearest found for each row of ``queries`` (query_id, vector) among ``index``
    (vec_id, vector): (query_id, rank, vec_id, score), rank from 1.  ``share``: the part of a
    shard that a query looks at, and ``least`` rows of it at least (ten for each of the
    ``k`` unless given), which sets recall against work.
    """
    least = 10 * k if least is None else least
    spark = index.sparkSession
    small_batches(spark, 5000)
    rows = index.where("vec_id is not null").where(usable(F.col("vector"))).select("vec_id", "vector", F.size("vector").alias("dim"))
    asked = queries.where("query_id is not null").where(usable(F.col("vector"))).select("query_id", "vector", F.size("vector").alias("dim"))
    shards = max(1, -(-rows.count() // shard_rows))
    blocks = max(1, -(-asked.count() // block_queries))
    here = rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    here = here.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    there = asked.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(seed)), F.lit(blocks)).cast("int"))
    there = there.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))

    def answer(own: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query_id": [], "vec_id": [], "score": []}
        if len(own) and len(asked):
            ids, vectors = own["vec_id"].to_numpy(), np.stack(own["vector"].to_numpy()).astype(np.float64)
            wanted, query_ids = np.stack(asked["vector"].to_numpy()).astype(np.float64), asked["query_id"].to_numpy()
            forest = Forest(vectors, trees, bits, seed)
            for q, near in enumerate(forest.candidates(wanted, max(least, int(np.ceil(share * len(ids)))))):
                near = near[ids[near] != query_ids[q]]
                # row by row alike, so that equal vectors have equal scores
                score = np.einsum("ij,j->i", vectors[near], wanted[q])
                best = np.lexsort((ids[near], -score))[:k] if len(near) <= 4 * k else _best(score, ids[near], k)
                out["query_id"].append(np.full(len(best), query_ids[q]))
                out["vec_id"].append(ids[near][best])
                out["score"].append(score[best])
        flat = {c: np.concatenate(v) if v else np.zeros(0) for c, v in out.items()}
        return pd.DataFrame(flat).astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    key = ["dim", "shard", "block"]
    found = there.groupBy(*key).cogroup(here.groupBy(*key)).applyInPandas(
        lambda a, b: answer(b, a), "query_id long, vec_id long, score double").distinct()
    first = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, equal ones by smaller id."""
    least = np.partition(score, -k)[-k]
    some = np.flatnonzero(score >= least)
    return some[np.lexsort((ids[some], -score[some]))[:k]]
