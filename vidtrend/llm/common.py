"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys
import tempfile
import uuid

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Python workers get this subpackage's functions with the job itself, so that
# executors need no installation of the library.
cloudpickle.register_pickle_by_value(sys.modules["vidtrend.llm"])

#: ASCII white space of the text contracts: [\x20\x09-\x0D]
ASCII_SPACE = " \t\n\x0b\x0c\r"

#: Holds what a Python worker keeps from task to task.
WORKER_STATE = "vidtrend_worker_state"

_local_shared: list[str] = []


def release_worker_state() -> None:
    """Called by tasks that need none of it, so its memory is theirs."""
    sys.modules.pop(WORKER_STATE, None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only a local-mode session without that setting (tests) gets a temporary
    folder, as driver and executors are then one process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _local_shared:
        _local_shared.append("file://" + tempfile.mkdtemp(prefix="vidtrend-llm-"))
    return _local_shared[0]


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the lineage ends here,
    and every later use sees the same rows even if executors are lost."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the rows of an Arrow batch, as texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def fresh(name: str, taken: list[str]) -> str:
    """A column name that is not among ``taken``."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def least_hashed(df: DataFrame, number: Column, n: int, then: list[str]) -> DataFrame:
    """The ``n`` rows with the smallest ``number``, a 64-bit hash, and of equal ones the smallest
    ``then``.  A threshold that lets about twice as many pass keeps all others from the sort,
    however many tasks there are; it rises while too few pass."""
    share = min(1.0, 2 * n / max(df.count(), 1))
    while share < 1:
        low = df.where(number < int(share * 2**64) - 2**63)
        if low.count() >= n:
            return low.orderBy(number, *then).limit(n)
        share = min(1.0, share * 4)
    return df.orderBy(number, *then).limit(n)


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x.astype(np.uint64, copy=False))


def min_labels(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Connected components of an edge list (``a``, ``b`` long): rows ``node``,
    ``root`` (smallest node reachable) for every node of an edge.

    Alternates two star contractions: each node's larger neighbours are linked to
    its smallest neighbour, then its smaller ones.  Components end as stars, after
    rounds that grow with the logarithm of their size; more than ``max_rounds`` are an error.  A node's neighbours are
    never gathered: minima are aggregated, and joined back on the edges, where
    adaptive execution splits a node with very many.  Each round is written out.
    """
    links = (edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
             .where("u <> v").distinct())
    links = keep(links, "links")
    seen = None
    for _ in range(max_rounds):
        # large star: every neighbour above u is linked to the least of u and its neighbours
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.join(least, "u").where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        # small star: u and its smaller neighbours are linked to the least of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        links = keep(small, "links")
        # unchanged if the links are the same set: then every component is a star
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"links still change after {max_rounds} rounds")
    return (links.select(F.col("u").alias("node"), F.col("v").alias("root"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()))
