"""Benchmark decontamination: a BM25 inverted index of test items, queried with
every passage of every document by block-max WAND.

The index holds, for every term, postings (item, weight) in item order, cut into
blocks of ``BLOCK`` items with the largest weight of each.  Weights are BM25 term
weights divided by the item's score for its own text, so that the threshold is a
share of what a full match scores.  Passages overlap such that any run of words as
long as the longest item lies wholly in one.  A passage first sums the block
maxima of its terms; blocks that cannot reach the threshold are skipped.  In the
blocks left, WAND moves the postings of the passage's terms: sorted by current
item, the pivot is the first term at which the summed maxima reach the threshold,
and only pivots that all earlier cursors agree on are scored.  Every (passage,
item) above the threshold is then verified on word shingles, the question part and
the answer part of the item each for itself.

The index is built over shards of at most ``shard_items`` items, so what a task
holds is bounded; each shard is one pass over the documents, without a shuffle.
Document frequencies, the mean length and the longest item are those of all items, counted
once, so scores and passages do not depend on how items are dealt into shards.

Defined results: words are runs of letters and digits in lower case; items and
texts that are null or without words match nothing; an item shorter than a shingle
is one shingle; repeated rows repeat in the result; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, release_worker_state, small_batches

WORDS = re.compile(r"\w+").findall
BLOCK = 4
#: Cells of the table of bounds (segments by blocks) that are held at once.
CELLS = 1 << 22
K1, B = 1.2, 0.75
#: Ids pass through pandas as text: a column of longs with a null would become floats.
MATCHES = "doc_id string, item_id long, score double, passage_start long, question_overlap double, answer_overlap double"


def words_of(text: str | None) -> list[str]:
    return WORDS((text or "").lower())


def parts_of(text: str | None) -> tuple[list[str], list[str]]:
    """(question words, answer words): the answer is the last line of several, else the
    last sentence of several, else there is none."""
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    if len(lines) < 2:
        lines = [x for x in re.split(r"(?<=[.?!])\s+", (text or "").strip()) if words_of(x)]
    if len(lines) < 2:
        return words_of(text), []
    return words_of(" ".join(lines[:-1])), words_of(lines[-1])


def shingles(words: list[str], n: int) -> set[tuple[str, ...]]:
    return {tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


@dataclass(frozen=True)
class Statistics:
    """Of all items that have words: how many there are, their mean and greatest number of
    words, and in how many a word stands (of the words that are asked for)."""

    items: int
    mean: float
    longest: int
    df: dict[str, int]


def statistics_of(items: list[tuple[int, str]]) -> Statistics:
    bags = [b for b in (Counter(words_of(t)) for _, t in items) if b]
    size = [sum(b.values()) for b in bags]
    return Statistics(len(bags), sum(size) / max(1, len(bags)), max(size, default=1), Counter(w for b in bags for w in b))


class ItemIndex:
    """Inverted index over (item_id, text) rows with block maxima; ``known`` are the statistics
    of all items where these are a part of them."""

    def __init__(self, items: list[tuple[int, str]], known: Statistics | None = None) -> None:
        known = known or statistics_of(items)
        bags = [Counter(words_of(t)) for _, t in items]
        # items with similar terms side by side: by their most widespread terms
        df = {w: known.df[w] for b in bags for w in b}
        order = sorted((k for k, b in enumerate(bags) if b),
                       key=lambda k: (sorted(bags[k], key=lambda w: (-df[w], w))[:3], k))
        self.items = [items[k] for k in order]
        bags = [bags[k] for k in order]
        n, size, mean = len(bags), [sum(b.values()) for b in bags], known.mean
        self.longest = known.longest
        self.term = {w: k for k, w in enumerate(sorted(df))}
        idf = {w: math.log(1 + (known.items - d + 0.5) / (d + 0.5)) for w, d in df.items()}
        #: by (term, block): the block's postings in item order
        self.postings: dict[tuple[int, int], list[tuple[int, float]]] = {}
        for k, (b, m) in enumerate(zip(bags, size)):
            weight = {w: idf[w] * c * (K1 + 1) / (c + K1 * (1 - B + B * m / mean)) for w, c in b.items()}
            own = sum(weight.values())
            for w, x in weight.items():
                self.postings.setdefault((self.term[w], k // BLOCK), []).append((k, x / own))
        self.blocks = -(-n // BLOCK)
        self.maxima = np.zeros((len(self.term) + 1, self.blocks), dtype=np.float32)
        for (t, block), posting in self.postings.items():
            self.maxima[t, block] = max(x for _, x in posting)

    def search(self, terms: list[int], blocks: list[int], threshold: float) -> list[tuple[int, float]]:
        """Block-max WAND over the items of the given blocks: (item, score) from the threshold on."""
        found = []
        for block in blocks:
            # postings, position, largest weight in the block
            cursors = [[p, 0, float(self.maxima[t, block])]
                       for t in terms if (p := self.postings.get((t, block)))]
            if sum(c[2] for c in cursors) < threshold:
                continue
            while cursors:
                cursors.sort(key=lambda c: c[0][c[1]][0])
                reach, pivot = 0.0, None
                for c in cursors:
                    reach += c[2]
                    if reach >= threshold:
                        pivot = c[0][c[1]][0]
                        break
                if pivot is None:
                    break
                if cursors[0][0][cursors[0][1]][0] == pivot:
                    at = [c for c in cursors if c[0][c[1]][0] == pivot]
                    score = sum(c[0][c[1]][1] for c in at)
                    if score >= threshold:
                        found.append((pivot, score))
                    for c in at:
                        c[1] += 1
                else:
                    for c in cursors:
                        while c[1] < len(c[0]) and c[0][c[1]][0] < pivot:
                            c[1] += 1
                cursors = [c for c in cursors if c[1] < len(c[0])]
        return found


def _candidates(index: ItemIndex, terms: list[np.ndarray], threshold: float):
    """(document, segment, blocks) of passages in which some block can reach the threshold.

    A passage is two neighbouring segments of as many words as the longest item.
    Block maxima are summed over the distinct terms of each segment; the sum over
    both segments bounds the passage.
    """
    seg = index.longest
    doc = np.repeat(np.arange(len(terms)), [len(t) for t in terms])
    place = np.concatenate([np.arange(len(t)) // seg for t in terms]) if terms else np.zeros(0, int)
    term = np.concatenate(terms) if terms else np.zeros(0, np.int64)
    known = term >= 0
    if not known.any():
        return
    first = np.concatenate(([0], np.cumsum([-(-len(t) // seg) for t in terms])))
    number = (first[doc] + place)[known]
    key = np.unique(number * np.int64(len(index.term)) + term[known])
    number, term = key // len(index.term), key % len(index.term)
    step = max(1, CELLS // index.blocks)  # segments, and terms, summed at once: bounded memory for texts of any length
    last = np.zeros(first[-1], dtype=bool)
    last[first[1:][first[1:] > first[:-1]] - 1] = True
    for low in range(0, len(last), step):
        high = min(len(last), low + step)
        bound = np.zeros((high - low + 1, index.blocks), dtype=np.float32)  # and the segment behind them
        begin, end = np.searchsorted(number, [low, high + 1])
        for a in range(begin, end, step):
            own = slice(a, min(end, a + step))
            starts = np.flatnonzero(np.append(True, np.diff(number[own]) != 0))
            bound[number[own][starts] - low] += np.add.reduceat(index.maxima[term[own]], starts, axis=0)
        both = bound[:-1] + np.where(last[low:high, None], 0, bound[1:])
        open_block = both >= threshold - 1e-4
        for n in np.flatnonzero(open_block.any(axis=1)):
            d = int(np.searchsorted(first, low + n, "right")) - 1
            yield d, int(low + n - first[d]), np.flatnonzero(open_block[n]).tolist()


def item_shards(items: DataFrame, shard_items: int = 4096):
    """The items' (id, text) rows in shards of about ``shard_items``, each with the statistics
    of all items; each task indexes one."""
    usable = items.where("item_id is not null and text is not null").select("item_id", "text")
    shards = max(1, -(-usable.count() // shard_items))
    usable = usable.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(shards)))

    def bags(batches):
        for pdf in batches:
            found = [words_of(t) for t in pdf["text"]]
            yield pd.DataFrame({"shard": pdf["shard"], "size": [len(w) for w in found], "words": [sorted(set(w)) for w in found]})

    counted = keep(usable.mapInPandas(bags, "shard long, size long, words array<string>").where("size > 0"), "items")
    n, total, longest = counted.agg(F.count("*"), F.sum("size"), F.max("size")).first()
    words = counted.select("shard", F.explode("words").alias("word"))
    df = keep(words.distinct().join(words.groupBy("word").agg(F.count("*").alias("n")), "word"), "item-words")
    for k in range(shards):
        own = {r.word: r.n for r in df.where(F.col("shard") == k).collect()}  # the words of one shard
        known = Statistics(n, (total or 0) / max(1, n), longest or 1, own)
        yield sorted((r.item_id, r.text) for r in usable.where(F.col("shard") == k).collect()), known


def find(index: ItemIndex, texts: list[str | None], threshold: float, shingle: int, overlap: float):
    """{(text number, item number): (score, first word of the passage, question overlap,
    answer overlap)} of the verified matches, for each its best passage."""
    seg, of = index.longest, index.term
    best: dict[tuple[int, int], tuple[float, int, float, float]] = {}
    if not of:
        return best
    terms = [np.array([of.get(w, -1) for w in words_of(t)], dtype=np.int64) for t in texts]
    current, words = -1, []
    for d, s, blocks in _candidates(index, terms, threshold):
        own = terms[d][s * seg:(s + 2) * seg]
        hits = index.search(np.unique(own[own >= 0]).tolist(), blocks, threshold)
        if hits and current != d:
            current, words = d, words_of(texts[d])
        there: dict[int, set] = {}
        for item, score in hits:
            shares = []
            for part in parts_of(index.items[item][1]):
                n = min(shingle, max(1, len(part)))
                if n not in there:
                    there[n] = shingles(words[s * seg:(s + 2) * seg], n)
                want = shingles(part, n)
                shares.append(len(want & there[n]) / len(want) if want else 1.0)
            row = (score, s * seg, *shares)
            if min(shares) >= overlap and ((d, item) not in best or sum(shares) > sum(best[d, item][2:])):
                best[d, item] = row
    return best


def matches(documents: DataFrame, items: DataFrame, threshold: float = 0.5, shingle: int = 5, overlap: float = 0.8,
            shard_items: int = 4096) -> DataFrame:
    """Rows (doc_id, item_id, score, passage_start, question_overlap, answer_overlap): every
    document and item whose question and answer shingles are both found, to the share
    ``overlap`` at least, in one passage of the document.  ``threshold``: share of the item's
    own BM25 score that a passage must reach to be verified.
    """
    spark = documents.sparkSession
    small_batches(spark, 500)
    out = None
    for shard in item_shards(items, shard_items):
        shared = spark.sparkContext.broadcast(shard)

        def run(batches, shared=shared):
            index = ItemIndex(*shared.value)
            for pdf in batches:
                found = find(index, pdf["text"].tolist(), threshold, shingle, overlap)
                yield pd.DataFrame({
                    "doc_id": pdf["doc_id"].iloc[[d for d, _ in found]].array,
                    "item_id": [index.items[i][0] for _, i in found],
                    **{c: [r[k] for r in found.values()]
                       for k, c in enumerate(("score", "passage_start", "question_overlap", "answer_overlap"))}})

        texts = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
        got = texts.mapInPandas(run, MATCHES).withColumn("doc_id", F.col("doc_id").cast("long"))
        out = got if out is None else out.unionByName(got)
    return out


def clean(documents: DataFrame, items: DataFrame, threshold: float = 0.5, shingle: int = 5, overlap: float = 0.8,
          shard_items: int = 4096) -> DataFrame:
    """The rows of ``documents`` in which no item is found; see ``matches``."""
    spark = documents.sparkSession
    small_batches(spark, 500)
    for shard in item_shards(items, shard_items):
        shared = spark.sparkContext.broadcast(shard)

        def run(batches, shared=shared):
            import pyarrow as pa

            release_worker_state()
            index = ItemIndex(*shared.value)
            for batch in batches:
                found = find(index, batch.column("text").to_pylist(), threshold, shingle, overlap)
                bad = {d for d, _ in found}
                yield batch.filter(pa.array([k not in bad for k in range(batch.num_rows)], pa.bool_()))

        documents = documents.mapInArrow(run, documents.schema)
    return documents
