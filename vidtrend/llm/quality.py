"""Quality classifier: supervised subword embeddings.

Every word of a text has a hashed vector; so have its character n-grams and each
pair of adjacent words.  A document is the mean of all of them, a softmax layer on
that mean gives the probability of each label.  Vectors and layer are learned
together by stochastic gradient descent in numpy on a bounded sample of labelled
documents, in a task of its own; scoring is one pass over the documents without a shuffle.

Defined results: a null or empty text has no features and scores the learned bias
alone; rows are scored one by one, so repeated rows and ids simply repeat; without
any usable label (empty tables, one class only) the score is the smoothed share
of label 1.  Extra input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidtrend.llm.common import release_worker_state, small_batches

NGRAMS = (3, 4)
SLICE_TOKENS = 100_000


@dataclass(frozen=True)
class QualityModel:
    """vectors (buckets x dim), layer (dim x 2), bias (2)."""

    vectors: np.ndarray
    layer: np.ndarray
    bias: np.ndarray

    @property
    def buckets(self) -> int:
        return len(self.vectors)


def _gram_hashes(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For distinct words: a 64-bit hash of each word, the buckets of its features
    (itself and its character n-grams, flat) and the first feature of each word."""
    coded = [w.encode() for w in words]
    buf = np.frombuffer(b"<" + b"><".join(coded) + b">", dtype=np.uint8).astype(np.uint64)
    size = np.fromiter(map(len, coded), dtype=np.int64, count=len(coded)) + 2
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    owner = np.repeat(np.arange(len(words)), size)
    mul, spread = np.uint64(0x100000001B3), np.uint64(0x9E3779B97F4A7C15)
    # whole-word hash: sum of bytes weighted by mixed positions, so one reduction gives all
    place = (np.arange(len(buf)) - start[owner]).astype(np.uint64)
    weight = (place + np.uint64(1)) * spread
    weight ^= weight >> np.uint64(29)
    word = np.add.reduceat((buf + np.uint64(1)) * (weight | np.uint64(1)) * mul, start)
    word ^= word >> np.uint64(31)
    ids, of = [_bucket(word, buckets)], [np.arange(len(words))]
    for n in NGRAMS:
        if len(buf) >= n:
            h = np.full(len(buf) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                h = (h ^ buf[k:len(buf) - n + 1 + k]) * mul
            inside = owner[:len(h)] == owner[n - 1:]
            ids.append(_bucket(h[inside], buckets))
            of.append(owner[:len(h)][inside])
    flat, of_all = np.concatenate(ids), np.concatenate(of)
    order = np.argsort(of_all, kind="stable")
    first = np.concatenate(([0], np.cumsum(np.bincount(of_all, minlength=len(words)))[:-1]))
    return word, flat[order], first


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return ((h >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _pairs(word: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of adjacent word pairs, from the word hashes in text order; a word
    followed by itself is one feature, whatever the word."""
    mixed = word[:-1] * np.uint64(31) + word[1:] + np.uint64(7)
    return _bucket(np.where(word[:-1] == word[1:], np.uint64(1), mixed), buckets)


def features(text: str | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature buckets of a text, and each one's share of all features."""
    words = (text or "").split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    word, flat, first = _gram_hashes(list(distinct), buckets)
    times = np.bincount(codes, minlength=len(distinct))
    size = np.diff(np.append(first, len(flat)))
    count = np.bincount(flat, weights=np.repeat(times, size), minlength=0)
    pairs = np.bincount(_pairs(word[codes], buckets)) if len(words) > 1 else np.zeros(0)
    total = np.zeros(max(len(count), len(pairs)))
    total[:len(count)] += count
    total[:len(pairs)] += pairs
    ids = np.flatnonzero(total)
    return ids, (total[ids] / total.sum()).astype(np.float32)


def mean_vectors(texts: list[str | None], vectors: np.ndarray) -> np.ndarray:
    """The mean feature vector of each text, in slices of bounded size."""
    buckets, dim = vectors.shape
    sums, counts = np.zeros((len(texts), dim), np.float64), np.zeros(len(texts))
    words: list[str] = []
    spans: list[tuple[int, int]] = []

    def flush() -> None:
        if not words:
            return
        codes, distinct = pd.factorize(np.array(words, dtype=object))
        word, flat, first = _gram_hashes(list(distinct), buckets)
        size = np.diff(np.append(first, len(flat)))
        of_word = np.add.reduceat(vectors[flat], first, axis=0)
        doc = np.repeat([d for d, _ in spans], [n for _, n in spans])
        starts = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
        sums[doc[starts]] += np.add.reduceat(of_word[codes], starts, axis=0)
        counts[doc[starts]] += np.add.reduceat(size[codes], starts)
        joined = doc[1:] == doc[:-1]
        if joined.any():
            pair, of = _pairs(word[codes], buckets)[joined], doc[1:][joined]
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            sums[of[starts]] += np.add.reduceat(vectors[pair], starts, axis=0)
            counts[of[starts]] += np.diff(np.append(starts, len(of)))
        words.clear()
        spans.clear()

    for k, text in enumerate(texts):
        own = (text or "").split()
        for at in range(0, len(own), SLICE_TOKENS):
            part = own[at:at + SLICE_TOKENS]
            if at:  # the pair across the cut
                edge = _gram_hashes(own[at - 1:at + 1], buckets)[0]
                sums[k] += vectors[_pairs(edge, buckets)[0]]
                counts[k] += 1
            words.extend(part)
            spans.append((k, len(part)))
            if len(words) >= SLICE_TOKENS:
                flush()
    flush()
    return sums / np.maximum(counts, 1)[:, None]


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], buckets: int, dim: int, epochs: int,
          rate: float, seed: int) -> QualityModel:
    """Stochastic gradient descent over (feature buckets, shares, label) rows."""
    rng = np.random.default_rng(seed)
    labels = np.array([y for _, _, y in rows], dtype=np.int64)
    share = (np.bincount(labels, minlength=2) + 1.0) / (len(rows) + 2.0)
    vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
    layer, bias = np.zeros((dim, 2), np.float32), np.log(share).astype(np.float32)
    if len(set(labels.tolist())) == 2:
        steps, done = epochs * len(rows), 0
        for _ in range(epochs):
            for k in rng.permutation(len(rows)):
                ids, part, y = rows[k]
                eta = np.float32(rate * (1 - done / steps))
                done += 1
                mean = part @ vectors[ids]
                z = mean @ layer + bias
                p = np.exp(z - z.max())
                p /= p.sum()
                p[y] -= 1
                back = layer @ p
                layer -= eta * np.outer(mean, p)
                bias -= eta * np.float32(0.1) * p
                # shares are small: a step per occurrence of the mean, as every feature of the text moves
                vectors[ids] -= (eta * part / part.max())[:, None] * back
    return QualityModel(vectors, layer, bias)


def fit(documents: DataFrame, labels: DataFrame, usable, max_rows: int = 3000, buckets: int = 1 << 16,
        dim: int = 16, epochs: int = 5, rate: float = 0.5, seed: int = 7) -> QualityModel:
    """Learn from at most ``max_rows`` labelled documents, half of them of each label
    if there are as many.  ``usable(doc_id column)`` says which ids may be learned from.

    The sample is the rows with the smallest hash of doc_id, so it is the same however
    the tables are laid out.  Its feature buckets meet in one task, which learns from them;
    only the model, whose size the parameters fix, reaches the driver.
    """
    spark = documents.sparkSession
    small_batches(spark)
    known = (labels.where("doc_id is not null and quality in (0, 1)").where(usable(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max(F.col("quality").cast("int")).alias("label")))
    by_hash = F.xxhash64("doc_id", F.lit(seed))
    # at most max_rows ids: the broadcast is bounded by the parameter
    sample = None
    for y in (0, 1):
        half = known.where(F.col("label") == y).orderBy(by_hash, "doc_id").limit(max(1, max_rows // 2))
        sample = half if sample is None else sample.unionByName(half)
    rows = (documents.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")))

    def turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_worker_state()
        for pdf in batches:
            out = [features(t, buckets) for t in pdf["text"]]
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "label": pdf["label"],
                                "ids": [i.astype(np.int32).tobytes() for i, _ in out],
                                "part": [p.tobytes() for _, p in out]})

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        release_worker_state()
        found = sorted((i, y, ids, part) for pdf in batches for i, y, ids, part in pdf.itertuples(index=False) if ids)
        own = [(np.frombuffer(ids, np.int32), np.frombuffer(part, np.float32), y) for _, y, ids, part in found]
        model, seen = train(own, buckets, dim, epochs, rate, seed), np.bincount([y for *_, y in own], minlength=2)
        yield pd.DataFrame([[x.tobytes() for x in (model.vectors, model.layer, model.bias)] + seen.tolist()],
                           columns=["vectors", "layer", "bias", "zeros", "ones"])

    # the sample meets in one task, not in the driver, which gets vectors of a fixed size only
    found = (rows.mapInPandas(turn, "doc_id long, label int, ids binary, part binary").repartition(1)
             .mapInPandas(learn, "vectors binary, layer binary, bias binary, zeros long, ones long").collect())
    totals = {r.label: r["count"] for r in known.groupBy("label").count().collect()}
    if found:
        vectors, layer, bias = (np.frombuffer(bytes(x), np.float32) for x in found[0][:3])
        model, seen = QualityModel(vectors.reshape(buckets, dim), layer.reshape(dim, 2), bias), found[0][3:]
    else:  # no task at all, as there are no rows
        model, seen = train([], buckets, dim, epochs, rate, seed), (0, 0)
    # the halves are balanced; the bias goes back to the shares of all usable labels
    n, m = np.array([totals.get(0, 0), totals.get(1, 0)]) + 1.0, np.array(seen) + 1.0
    return QualityModel(model.vectors, model.layer, (model.bias + np.log(n / n.sum()) - np.log(m / m.sum())).astype(np.float32))


def score(documents: DataFrame, model: QualityModel, threshold: float = 0.7) -> DataFrame:
    """The rows of ``documents`` with ``score`` (probability of label 1) and
    ``predicted`` (1 from ``threshold`` on); columns of these names are replaced."""
    spark = documents.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.vectors, model.layer, model.bias))
    kept = documents.drop("score", "predicted")
    schema = kept.select("*", F.lit(0.0).alias("score"), F.lit(0).alias("predicted")).schema

    def run(batches):
        import pyarrow as pa

        release_worker_state()
        vectors, layer, bias = shared.value
        for batch in batches:
            texts = batch.column("text").to_pylist()
            z = mean_vectors(texts, vectors) @ layer.astype(np.float64) + bias
            p = 1 / (1 + np.exp(np.clip(z[:, 0] - z[:, 1], -700, 700)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))],
                names=[*batch.schema.names, "score", "predicted"])

    return kept.mapInArrow(run, schema)
