"""Mixture-controlled packing of documents into token sequences.

Documents are tokenized once and written.  They are dealt by hash into lanes of
about ``lane_tokens`` tokens; a lane is one task's work.  In a lane each source is
a queue, and deficit round-robin serves the queues: every round grants each queue
its target share of a window, a queue is served once its credit reaches
``quantum`` tokens, and what is over or short stays as its deficit for the next
windows.  Deficits also pass from lane to lane: as a lane serves all of its own
documents, the deficit of a source at a lane's start is its target share of all
earlier lanes' tokens less its tokens there, a prefix sum over a small table.  So
lanes run in parallel and are packed as if one after the other.

Sequences are full windows; a lane's rest is cut into powers of two, which need
no padding.

Defined results: a null or empty text is its end token alone; a null source is the
empty source; rows with equal or null ids are packed each for itself; an empty
table gives no pieces.  Extra input columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, small_batches
from vidtrend.llm.tokens import shared_encoder

PIECES = ("doc_id string, source string, start long, length long, doc_tokens long, "
          "sequence_id long, offset long, ids binary")


def tokenize(documents: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Rows (doc_id as text, source, n, ids): ids are little-endian unsigned integers of two
    bytes (four for a vocabulary over 65,536), the end id included."""
    small_batches(documents.sparkSession)

    def run(batches):
        encoder = shared_encoder(tokenizer)
        width = encoder.dtype.itemsize
        for batch in batches:
            ids = encoder.encode(batch.column("text"), [end_id])
            n = pc.divide(pc.binary_length(ids), width)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("source"), n.cast(pa.int64()), pa.array([width] * len(ids), pa.int32()), ids],
                names=["doc_id", "source", "n", "width", "ids"])

    # ids pass through pandas as text: a column of longs with a null would become floats
    return (documents.select(F.col("doc_id").cast("string").alias("doc_id"), F.coalesce("source", F.lit("")).alias("source"), "text")
            .mapInArrow(run, "doc_id string, source string, n long, width int, ids binary"))


def serve(queues: list[int], share: list[float], credit: list[float], window: int,
          quantum: int) -> list[tuple[int, int]]:
    """Deficit round-robin over queues of so many tokens: (queue, tokens served) in order."""
    left, credit, turns = list(queues), list(credit), []
    while active := [s for s, n in enumerate(left) if n]:
        # rounds in which no queue reaches its quantum are granted at once
        wait = min(math.ceil((min(quantum, left[s]) - credit[s]) / (share[s] * window)) for s in active)
        for s in active:
            credit[s] += share[s] * window * max(1, wait)
            if credit[s] >= min(quantum, left[s]):
                n = min(int(credit[s]), left[s])
                turns.append((s, n))
                left[s] -= n
                credit[s] -= n
    return turns


def sequence_ends(tokens: int, window: int) -> list[int]:
    """Ends of a lane's sequences: full windows, then powers of two for the rest."""
    ends = list(range(window, tokens + 1, window))
    at, rest = tokens - tokens % window, tokens % window
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            ends.append(at)
    return ends


def _sequences(tokens: Column, window: int) -> Column:
    """How many sequences ``sequence_ends`` makes."""
    return F.floor(tokens / window) + F.bit_count(tokens % window)


def _mixable(held: DataFrame, targets: dict[str, float]) -> tuple[Column, int]:
    """The part of each source's tokens that a mixture at ``targets`` can use, and the sum of
    all tokens.  Sources that are not named count with their own shares."""
    total = held.agg(F.sum("held")).first()[0] or 0
    named = {r.source: r.held for r in held.where(F.col("source").isin(list(targets))).collect()}  # of a list a user writes
    rest = 1 - sum(named.values()) / max(total, 1)
    weights = {source: max(0.0, targets[source]) for source in named}
    every = sum(weights.values()) + rest
    # the source that runs out first bounds the tokens of the mixture
    most = min([named[s] * every / w for s, w in weights.items() if w > 0] + [total * every], default=0)
    part = F.lit(min(1.0, most / every / total) if total and every else 1.0)
    for source, w in weights.items():
        part = F.when(F.col("source") == source, F.lit(min(1.0, most * w / every / named[source]) if every else 1.0)).otherwise(part)
    return part, total


def _earlier(rows: DataFrame, sums: dict[str, Column], keys: list[str], block: int = 4096) -> DataFrame:
    """``rows`` (``keys``, lane, ...) with the sums of columns over the rows of earlier lanes:
    within blocks of lanes, and over the blocks."""
    rows = rows.withColumn("block", F.floor(F.col("lane") / block)).withColumns({f"own_{c}": x for c, x in sums.items()})
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(*keys, "block").agg(*[F.sum(f"own_{c}").alias(f"own_{c}") for c in sums])
    blocks = blocks.select(*keys, "block", *[F.coalesce(F.sum(f"own_{c}").over(before), F.lit(0)).alias(f"all_{c}") for c in sums])
    inside = Window.partitionBy(*keys, "block").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    found = rows.join(blocks, [*keys, "block"])
    return found.withColumns({c: F.col(f"all_{c}") + F.coalesce(F.sum(f"own_{c}").over(inside), F.lit(0)) for c in sums})


def pack(documents: DataFrame, tokenizer: str, end_id: int = 2, window: int = 4096, quantum: int = 512,
         lane_tokens: int = 1 << 20, targets: dict[str, float] | None = None) -> DataFrame:
    """Pieces (doc_id, source, start, length, doc_tokens, sequence_id, offset, ids) that
    hold every token of every document exactly once; ``ids`` as little-endian
    unsigned 32-bit integers.

    ``targets`` are the wanted shares of tokens by source; sources not named, and all
    sources by default, count with their own tokens, so that all queues end together.
    Where targets differ from what the sources hold, the lanes are of two kinds: as many
    tokens as can be mixed at the targets, drawn by hash, fill the first lanes, and what
    the other sources have over goes to the last ones, in the proportions it has there.
    ``window`` is a power of two.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("window must be a power of two")
    small_batches(documents.sparkSession)
    tokens = keep(tokenize(documents, tokenizer, end_id), "tokens")
    hashed = lambda salt: F.xxhash64("doc_id", "n", F.crc32("ids"), *[F.lit(x) for x in salt])
    if targets:
        part, total = _mixable(tokens.groupBy("source").agg(F.sum("n").alias("held")), targets)
        tokens = tokens.withColumn("over", (F.pmod(hashed([1]), F.lit(1 << 30)) >= part * (1 << 30)).cast("int"))
    else:
        tokens, total = tokens.withColumn("over", F.lit(0)), tokens.agg(F.sum("n")).first()[0] or 0
    # lanes of the mixture, then those of what is over
    sizes = {r.over: r.n for r in tokens.groupBy("over").agg(F.sum("n").alias("n")).collect()} if targets else {0: total}
    lanes = [max(1, math.ceil(sizes.get(k, 0) / lane_tokens)) for k in (0, 1)]
    lane = F.pmod(hashed([]), F.when(F.col("over") == 0, F.lit(lanes[0])).otherwise(F.lit(lanes[1])))
    tokens = tokens.withColumn("lane", lane + F.col("over") * lanes[0])
    held = keep(tokens.groupBy("lane", "source", "over").agg(F.sum("n").alias("held")), "lanes")

    # shares by source, then what each lane inherits: sums over all earlier lanes of its kind
    own = held.groupBy("source", "over").agg(F.sum("held").cast("double").alias("weight"))
    share = (own.join(own.groupBy("over").agg(F.sum("weight").alias("every")), "over")
             .select("source", "over", (F.col("weight") / F.col("every")).alias("share")))
    by_lane = (held.groupBy("lane", "over").agg(F.sum("held").alias("tokens"))
               .withColumn("sequences", _sequences(F.col("tokens"), window)))
    # sequences of the mixture come first
    mixture = by_lane.where("over = 0").agg(F.sum("sequences")).first()[0] if targets else 0
    by_lane = (_earlier(by_lane, {"before": F.col("tokens"), "first": F.col("sequences")}, ["over"])
               .select("lane", "before", (F.col("first") + F.col("over") * F.lit(mixture or 0)).alias("first")))
    starts = (_earlier(held, {"served": F.col("held")}, ["over", "source"])
              .join(share, ["source", "over"]).join(by_lane, "lane")
              .select("lane", "source", "share", "first",
                      (F.col("share") * F.col("before") - F.col("served")).alias("deficit")))

    def fill(docs: pd.DataFrame, start: pd.DataFrame) -> pd.DataFrame:
        # by content, as a shuffle may bring rows in any order
        docs = docs.assign(crc=docs["ids"].map(zlib.crc32)).sort_values(["source", "doc_id", "n", "crc"], kind="stable")
        start = start.sort_values("source")
        order = {s: k for k, s in enumerate(start["source"])}
        queue: list[list[int]] = [[] for _ in order]
        sizes = docs["n"].tolist()
        for row, s in enumerate(docs["source"]):
            queue[order[s]].append(row)
        turns = serve([sum(sizes[row] for row in q) for q in queue], start["share"].tolist(),
                      start["deficit"].tolist(), window, quantum)
        ends = sequence_ends(sum(sizes), window)
        dtype = "<u2" if docs["width"].iloc[0] == 2 else "<u4"
        texts = [np.frombuffer(x, dtype).astype("<u4").tobytes() for x in docs["ids"]]
        doc_ids, sources = docs["doc_id"].tolist(), docs["source"].tolist()
        head, done = [0] * len(queue), [0] * len(queue)
        out, at, seq, began = [], 0, 0, 0
        for s, n in turns:
            while n:
                row = queue[s][head[s]]
                take = min(n, sizes[row] - done[s], ends[seq] - at)
                ids = texts[row][4 * done[s]:4 * (done[s] + take)]
                last = out[-1] if out else None
                if last and last[0] == row and last[5] == seq and last[2] + last[3] == done[s]:
                    last[3] += take  # goes on where the piece before it ends
                    last[7] += ids
                else:
                    out.append([row, sources[row], done[s], take, sizes[row], seq, at - began, ids])
                at, n, done[s] = at + take, n - take, done[s] + take
                if done[s] == sizes[row]:
                    head[s], done[s] = head[s] + 1, 0
                if at == ends[seq]:
                    seq, began = seq + 1, at
        first = int(start["first"].iloc[0])
        got = pd.DataFrame(out, columns=["doc_id", "source", "start", "length", "doc_tokens",
                                         "sequence_id", "offset", "ids"])
        got["doc_id"] = [doc_ids[r] for r in got["doc_id"]]
        got["sequence_id"] += first
        return got

    pieces = tokens.groupBy("lane").cogroup(starts.groupBy("lane")).applyInPandas(fill, PIECES)
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))
