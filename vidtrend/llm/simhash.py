"""SimHash near-duplicates with a Gray-order hierarchical index.

A fingerprint is the majority, bit by bit, of the 64-bit hashes of a text's word
shingles.  Distinct fingerprints are ordered by Gray rank, the order in which
neighbours differ in few bits, and cut into blocks of equal size.  A node of the
index holds the bits that all fingerprints below it share.  The upper nodes lie
over the blocks, the lower ones over the fingerprints of a block.  A query
descends with the differences found so far: a node adds those in the bits which
its parent did not fix yet, and a whole group is pruned once they exceed the limit.

Every fingerprint descends the upper nodes and is sent to the blocks that remain;
each block finds the links of what it got, and keeps a spanning forest of them.
Components follow from these links.  As fingerprints are distinct a block never
grows with a group of equal texts, and block bounds are quantiles of Gray rank,
so near copies spread over blocks too.

Defined results: null and empty texts have fingerprint zero, which links like any
other; rows with null ids take part, and a component's id is its smallest id that
is not null (null if there is none); repeated rows stay repeated; an empty table
gives an empty result.  Other columns are kept; columns named like the results
are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vidtrend.llm.common import fresh, keep, min_labels, popcount, release_worker_state, small_batches

SEED = 42
FAN = 8
#: Bound of the upper nodes; beyond it blocks grow.
MOST_BLOCKS = 1 << 14
#: Pairs of query and node looked at together, which bounds a task's memory.
FRONT = 1 << 20


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the XXH64 hashes of the text's word shingles."""
    from xxhash import xxh64_intdigest

    # bytes: lower() and split() then know ASCII letters and white space only
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    parts = map(b" ".join, zip(*(words[k:] for k in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.array([xxh64_intdigest(p, SEED) for p in parts], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int, columns: list[str], name: str = "fp") -> DataFrame:
    """The ``columns`` of ``documents`` and the fingerprint of ``text`` as a signed long."""
    small_batches(documents.sparkSession)
    text = fresh("text_in", columns)
    docs = documents.select(*columns, F.col("text").alias(text))
    schema = documents.select(*columns, F.lit(0).cast("long").alias(name)).schema

    def run(batches):
        import pyarrow as pa

        release_worker_state()
        for batch in batches:
            *rest, texts = batch.columns
            fp = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([*rest, pa.array(fp.view(np.int64))], names=[*columns, name])

    return docs.mapInArrow(run, schema)


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """The place of each code word (unsigned) in the Gray sequence."""
    rank = fp.copy()
    for k in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(k)
    return rank


class GrayTree:
    """Index over fingerprints (or over nodes with shared bits) in Gray order.

    levels[0] are the leaves, each further level joins FAN nodes.  ``new`` are the
    bits a node fixes and its parent does not.
    """

    def __init__(self, bits: np.ndarray, shared: np.ndarray) -> None:
        self.levels = [(bits, shared)]
        while len(bits) > 1:
            first = np.arange(0, len(bits), FAN)
            ones, zeros = bits & shared, ~bits & shared
            shared = np.bitwise_and.reduceat(ones, first) | np.bitwise_and.reduceat(zeros, first)
            bits = np.bitwise_and.reduceat(ones, first)
            self.levels.append((bits, shared))

    def search(self, queries: np.ndarray, limit: int):
        """Yields (query, leaf) index arrays within ``limit`` differing shared bits."""
        if not len(self.levels[0][0]):
            return
        bits, shared = self.levels[-1]
        step = max(1, FRONT // (FAN * len(bits)))
        for at in range(0, len(queries), step):
            q = np.repeat(np.arange(at, min(at + step, len(queries))), len(bits))
            node = np.tile(np.arange(len(bits)), len(q) // len(bits))
            diff = popcount((queries[q] ^ bits[node]) & shared[node])
            yield from self._below(queries, q, node, diff, len(self.levels) - 1, limit)

    def _below(self, queries, q, node, diff, level, limit):
        near = diff <= limit
        q, node, diff = q[near], node[near], diff[near]
        if level == 0:
            if len(q):
                yield q, node
            return
        bits, shared = self.levels[level - 1]
        above = self.levels[level][1]
        for at in range(0, len(q), FRONT // FAN):
            part = slice(at, at + FRONT // FAN)
            child = (node[part, None] * FAN + np.arange(FAN)).ravel()
            real = child < len(bits)
            child, qq = child[real], np.repeat(q[part], FAN)[real]
            new = shared[child] & ~np.repeat(above[node[part]], FAN)[real]
            more = np.repeat(diff[part], FAN)[real] + popcount((queries[qq] ^ bits[child]) & new)
            yield from self._below(queries, qq, child, more, level - 1, limit)


def forest(a: np.ndarray, b: np.ndarray, n: int, parent: np.ndarray | None = None) -> np.ndarray:
    """Smallest reachable index for n nodes under links a-b, going on from ``parent``."""
    parent = np.arange(n) if parent is None else parent
    while True:
        pa, pb = parent[a], parent[b]
        live = pa != pb
        if not live.any():
            return parent
        a, b, pa, pb = a[live], b[live], pa[live], pb[live]
        np.minimum.at(parent, np.maximum(pa, pb), np.minimum(pa, pb))
        while (up := parent[parent]).tobytes() != parent.tobytes():
            parent = up


def link_fingerprints(distinct: DataFrame, max_bits: int = 2, block_rows: int = 1 << 16) -> DataFrame:
    """Links (a, b) that connect exactly what pairs within ``max_bits`` connect.

    ``distinct``: distinct fingerprints in column ``fp``, written out.  The index has
    a block for every ``block_rows`` of them, but from 64 to MOST_BLOCKS blocks in all;
    the driver and every task hold three numbers for each.
    """
    spark = distinct.sparkSession
    blocks = min(MOST_BLOCKS, max(64, -(-distinct.count() // block_rows)))
    flip = np.int64(-(1 << 63))  # unsigned order as the order of signed numbers

    def rank_of(fp: np.ndarray) -> np.ndarray:
        return gray_rank(fp.view(np.uint64)).view(np.int64) ^ flip

    # each step goes from the fingerprints on: a chain of Python steps would hold a worker of its own for
    # every step and task, which stay and fill with what later tasks keep
    def ranks(batches):
        for pdf in batches:
            yield pd.DataFrame({"rank": rank_of(pdf["fp"].to_numpy())})

    ranked = distinct.select("fp").mapInPandas(ranks, "rank long")
    marks = F.array(*[F.lit(k / blocks) for k in range(1, blocks)])
    bounds = np.array(ranked.agg(F.percentile_approx("rank", marks, 100 * blocks)).first()[0] or [], dtype=np.int64)

    def block_of(fp: np.ndarray) -> np.ndarray:
        return np.searchsorted(bounds, rank_of(fp)).astype(np.int32)

    def deal(batches):
        for pdf in batches:
            yield pd.DataFrame({"fp": pdf["fp"], "block": block_of(pdf["fp"].to_numpy())})

    dealt = distinct.select("fp").mapInPandas(deal, "fp long, block int")
    tops = (dealt.groupBy("block").agg(F.expr("bit_and(fp)").alias("ones"), F.expr("bit_and(~fp)").alias("zeros"))
            .orderBy("block").collect())
    number = np.array([t.block for t in tops], dtype=np.int32)
    ones = np.array([t.ones for t in tops], dtype=np.int64).view(np.uint64)
    zeros = np.array([t.zeros for t in tops], dtype=np.int64).view(np.uint64)
    upper = spark.sparkContext.broadcast((number, ones, ones | zeros))

    def route(batches):
        number, bits, shared = upper.value
        tree = GrayTree(bits, shared)
        for pdf in batches:
            fp = pdf["fp"].to_numpy()
            own = block_of(fp)
            for q, leaf in tree.search(fp.view(np.uint64), max_bits):
                # two blocks meet once; which of them has guests changes from pair to pair
                to, home = number[leaf], own[q]
                meet = (to == home) | (((to + home) % 2 == 0) == (to < home))
                yield pd.DataFrame({"block": to[meet], "fp": fp[q[meet]], "guest": (to != home)[meet]})

    sent = distinct.select("fp").mapInPandas(route, "block int, fp long, guest boolean")

    def links(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy().view(np.uint64)
        guest = pdf["guest"].to_numpy()
        own, others = np.sort(fp[~guest]), fp[guest]
        own = own[np.argsort(gray_rank(own))]
        tree = GrayTree(own, np.full(len(own), ~np.uint64(0)))
        every = np.concatenate((own, others))
        parent = None
        for q, leaf in tree.search(every, max_bits):
            parent = forest(q, leaf, len(every), parent)
        if parent is None:
            return pd.DataFrame({"a": [], "b": []}, dtype=np.int64)
        child = np.flatnonzero(parent != np.arange(len(every)))
        return pd.DataFrame({"a": every[parent[child]].view(np.int64), "b": every[child].view(np.int64)})

    return sent.groupBy("block").applyInPandas(links, "a long, b long")


def _labelled(documents: DataFrame, carried: list[str], shingle: int, max_bits: int) -> tuple[DataFrame, str, DataFrame]:
    """The carried columns with the fingerprint, its column's name, and for every
    distinct fingerprint (fp, root, component_id)."""
    fp = fresh("fp", carried)
    prints = keep(fingerprints(documents, shingle, carried, fp), "prints")
    distinct = keep(prints.groupBy(F.col(fp).alias("fp")).agg(F.min("doc_id").alias("least")), "distinct")
    links = keep(link_fingerprints(distinct, max_bits), "pairs")
    root = min_labels(links)
    named = (distinct.join(root, distinct["fp"] == root["node"], "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    groups = named.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints, fp, keep(named.select("fp", "root").join(groups, "root").select("fp", "root", "component_id"), "named")


def components(documents: DataFrame, shingle: int = 3, max_bits: int = 2, columns: list[str] | None = None) -> DataFrame:
    """``documents`` (or their ``columns``) with ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest doc_id of all documents linked directly or through others;
    ``component`` names the component even where all its ids are null."""
    carried = [c for c in columns or documents.columns if c.lower() not in ("fingerprint", "component_id", "component")]
    prints, fp, named = _labelled(documents, carried, shingle, max_bits)
    return (prints.alias("d").join(named.alias("x"), F.col(f"d.{fp}") == F.col("x.fp"))
            .select(*[F.col(f"d.{c}") for c in carried],
                    F.lpad(F.lower(F.hex(F.col("x.fp"))), 16, "0").alias("fingerprint"), F.col("x.component_id"),
                    F.col("x.root").alias("component")))


def one_of_each(documents: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each component: the one with its component's id, of repeated ids
    the one with the smallest text.  The first of each fingerprint is chosen before the
    join, the first of each component after it; a task passes one row of each on."""
    prints, fp, named = _labelled(documents, documents.columns, shingle, max_bits)
    rank, root = fresh("rank", prints.columns), fresh("root", prints.columns)

    def first(rows: DataFrame, group: str) -> DataFrame:
        order = Window.partitionBy(group).orderBy(F.col("doc_id").asc_nulls_last(), F.col("text"))
        return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) == 1).drop(rank)

    joined = first(prints, fp).join(named.select(F.col("fp").alias(fp), F.col("root").alias(root)), fp)
    return first(joined, root).select(*documents.columns)
