"""Audit of how far the sources of a language diverge in their words.

Tokenizer: one 256-entry table for ``bytes.translate`` lowers A-Z and turns every
other ASCII byte that is no letter into a blank, in one pass over the UTF-8 text;
``bytes.split`` gives the terms, a ``Counter`` per document its frequencies.  A task
adds its documents' counters up per (language, source) and hands over sparse rows
(lang, source, term, occurrences, documents) whenever it holds ``flush`` of them, so
a word of every document is a row per task and source, and memory is bounded.

Spark adds the rows up.  A language keeps the terms of at least ``min_docs`` of its
documents; only cells that occur are stored, a term that a source lacks has the
source's smoothed zero.  Sources are compared in blocks of terms by blocks of
sources, so neither a language with many terms nor one with many sources meets in
one task, and the shared part of terms that both lack is added as a count.

All arithmetic is on integers: a probability is 1 + floor(scale (count + alpha) / (N + alpha V)).
The division is done in two steps that stay within 63 bits for counts to 9e13.

Defined results: null text, language and source are ''; every row is a document,
equal rows and ids included; a group without terms is compared as well, and one
whose language keeps no term has distance 0 to all others; an empty table gives an
empty result.  Other columns are not read; ``doc_id`` is not needed.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, release_worker_state

#: Lowers A-Z, keeps a-z and every byte of a non-ASCII character, blanks all others.
TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))
SCALE = 1_000_000_000
COUNTS = "lang string, source string, term binary, n long, docs long"


def terms(text: bytes) -> list[bytes]:
    return text.translate(TERM_BYTES).split()


def count_terms(batches: Iterator[pa.RecordBatch], flush: int) -> Iterator[pa.RecordBatch]:
    release_worker_state()
    counts: dict[tuple, tuple[Counter, Counter]] = {}
    held = 0

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(n.keys(), pa.binary()),
                 pa.array(n.values(), pa.int64()), pa.array(map(docs.__getitem__, n), pa.int64())],
                ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), batch["text"]):
            frequencies = Counter(terms(text.as_py()))
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            held -= len(n)
            n.update(frequencies)
            docs.update(frequencies.keys())
            held += len(n)
            if held >= flush:
                yield from rows()
                counts.clear()
                held = 0
    yield from rows()


def probability(count: Column, total: Column, kept: Column, alpha: int) -> Column:
    """1 + floor(SCALE (count + alpha) / (total + alpha kept)), exactly; 1 where no term is kept."""
    a, b = count + F.lit(alpha), F.greatest(total + F.lit(alpha) * kept, F.lit(1))
    high = a * 100_000
    return F.lit(1) + F.call_function("div", high, b) * 10_000 + F.call_function("div", (high % b) * 10_000, b)


def _block_distances(cells: pd.DataFrame) -> pd.DataFrame:
    """Distances of the sources of two blocks over one block of terms.

    A row without a term says that a source is in the block, with its zero."""
    present = cells[cells["term"].isna()]
    left, right = (present[present["side"] == side] for side in (0, 1))
    own = cells[cells["term"].notna()]
    codes, found = pd.factorize(own["term"])
    matrices = []
    for side, sources in enumerate((left, right)):
        zero = sources["p"].to_numpy()
        matrix = np.repeat(zero[:, None], len(found), axis=1)
        mine = (own["side"] == side).to_numpy()
        row = pd.Index(sources["source"]).get_indexer(own["source"][mine])
        matrix[row, codes[mine]] = own["p"].to_numpy()[mine]
        matrices.append((sources["source"].to_numpy(), zero, matrix))
    (names, zeros, p), (others, other_zeros, q) = matrices
    value = np.array([np.abs(q - mine).sum(axis=1) for mine in p], np.int64).reshape(-1)
    gap = np.abs(zeros[:, None] - other_zeros[None, :]).reshape(-1)
    rows = pd.DataFrame({"lang": cells["lang"].iloc[0], "source": np.repeat(names, len(others)), "item": np.tile(others, len(names)),
                         "value": value, "gap": gap, "n_terms": len(found), "kept": cells["kept"].iloc[0]})
    return rows[rows["source"] != rows["item"]]


def audit(documents: DataFrame, min_docs: int = 30, alpha: int = 5, top_terms: int = 50, flush: int = 200_000,
          term_block: int = 1024, source_block: int = 128) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of every (lang, source) of ``documents``.

    Part ``pair``: the other sources of the language by the sum of the differences of
    their probabilities over all kept terms.  Part ``term``: the ``top_terms`` terms
    that the source has and uses more than the language does, by that excess.  Equal
    values are ranked by item.
    """
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    docs = documents.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source")], text)
    sparse = docs.mapInArrow(lambda batches: count_terms(batches, flush), COUNTS)
    counts = keep(sparse.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "counts")
    vocabulary = (counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs"))
                  .where(F.col("docs") >= min_docs).drop("docs"))
    cells = keep(counts.drop("docs").join(vocabulary, ["lang", "term"])
                 .select("lang", "source", F.col("term").cast("string").alias("term"), "n", "lang_n"), "cells")
    # every language's kept terms and sources, every group's total
    by_term = cells.groupBy("lang", "term").agg(F.first("lang_n").alias("lang_n"))
    langs = by_term.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
    groups = docs.groupBy("lang", "source").agg(F.count("*").alias("rows"))
    sources = groups.groupBy("lang").agg(F.count("*").alias("n_sources"))
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("long")
    sizes = keep(groups.select("lang", "source").join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sources, "lang")
                 .select("lang", "source", "n_sources", *[F.coalesce(F.col(c), none).alias(c) for c in ("total", "kept", "lang_total")]), "sizes")
    term_blocks = F.greatest(F.ceil(F.col("kept") / term_block), F.lit(1)).cast("int")
    source_blocks = F.ceil(F.col("n_sources") / source_block).cast("int")
    own_block = F.pmod(F.xxhash64("source"), source_blocks).cast("int")

    scored = cells.join(sizes, ["lang", "source"])
    p = probability(F.col("n"), F.col("total"), F.col("kept"), alpha)
    zero = probability(none, F.col("total"), F.col("kept"), alpha)
    held = scored.select("lang", "source", "term", p.alias("p"), "kept", own_block.alias("own"), source_blocks.alias("blocks"),
                         F.pmod(F.xxhash64("term"), term_blocks).cast("int").alias("part"))
    absent = sizes.select("lang", "source", F.lit(None).cast("string").alias("term"), zero.alias("p"), "kept", own_block.alias("own"),
                          source_blocks.alias("blocks"), F.explode(F.sequence(F.lit(0), term_blocks - 1)).alias("part"))
    # a source's block stands on the left of every pair of blocks, and on the right of every one
    dealt = (held.unionByName(absent)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))))
    block = [F.when(F.col("side") == side, F.col("own")).otherwise(F.col("other")).alias(name) for side, name in ((0, "left"), (1, "right"))]
    dealt = dealt.select("lang", "part", *block, "side", "source", "term", "p", "kept")
    partial = dealt.groupBy("lang", "part", "left", "right").applyInPandas(
        _block_distances, "lang string, source string, item string, value long, gap long, n_terms long, kept long")
    summed = partial.groupBy("lang", "source", "item").agg(
        *[F.sum(c).alias(c) for c in ("value", "n_terms")], *[F.max(c).alias(c) for c in ("gap", "kept")])
    ranks = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = summed.select("lang", "source", F.lit("pair").alias("part"), "item",
                          (F.col("value") + (F.col("kept") - F.col("n_terms")) * F.col("gap")).alias("value"))
    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("kept"), alpha)
    excess = scored.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    tops = excess.withColumn("rank", F.row_number().over(ranks)).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", F.row_number().over(ranks)).unionByName(tops)
