"""Removal of repeated passages with sharded Aho-Corasick automata.

A passage repeats where a window of ``length`` words also starts earlier (in a
smaller doc_id, or before in the same document).  Documents are dealt by id into
shards of about ``shard_bytes`` of text, a table bucketed by shard, so that every
pass meets them without moving texts.

1. Nominate.  Every window has an anchor, the least hash among its runs of ``ANCHOR``
   words; equal windows have equal anchors.  Each shard sends the hashes of its anchors once.
   An anchor that stands only once in all documents ends there; the others go back to their shards.
2. Confirm.  Each shard sends a 96-bit hash of the windows of those anchors, once, with
   the smallest doc_id that holds it.  Windows that stand once end there; the recurring
   ones go back to their shards, and the shard that has the smallest doc_id is told so.
3. Compile.  A shard takes its confirmed passages, phrases of neighbouring windows with one
   anchor, and compiles them into Aho-Corasick automata of at most ``patterns`` phrases
   each, over the words as symbols.
4. Stream.  All documents of the shard run through each automaton, which finds every
   place of every phrase by its words.  A window's first place of all goes free, all others
   lose the words they cover.

A window is a row per shard at most, so neither a passage of a third of all documents nor a
large group of copies makes a large group; tasks hold one shard.

Defined results: a null text is no words and becomes '', as does an empty one.  Words are joined by one blank.
A null doc_id is smaller than all others; rows with equal ids are ordered by their texts; rows
equal in id and text are one document, and all get its result.  An empty table gives an
empty result.  Other columns are kept; columns named like the results are replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vidtrend.llm.common import fresh, release_worker_state, shared_path

#: Words of an anchor.
ANCHOR = 8
#: Odd multipliers and the steps of a 64-bit finalizer: fixed values.
BYTE_BASE, WORD_BASES = 0x9E3779B97F4A7C15, (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
SLICE = 1 << 18
IS_BLANK = np.isin(np.arange(256), [32, *range(9, 14)])
#: A word of an automaton is WIDTH characters, each out of BASE of its own: short child
#: lists, as the library searches them one by one, and no match inside a word.
WIDTH, BASE = 3, 80


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * MIX_1
    x = (x ^ (x >> np.uint64(27))) * MIX_2
    return x ^ (x >> np.uint64(31))


def _power(base: int, n: int) -> np.uint64:
    return np.uint64(pow(base, n, 1 << 64))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Shard:
    """A shard's documents in order, their words as spans of one buffer."""

    def __init__(self, table: pa.Table) -> None:
        ids, texts = table["doc_id"].to_pylist(), [(t or b"") for t in table["text"].to_pylist()]
        keys = [((i is not None, i if i is not None else 0), t) for i, t in zip(ids, texts)]
        order = sorted(range(len(keys)), key=keys.__getitem__)
        # rows equal in id and text share one place
        self.place, self.ids, self.texts = [0] * len(keys), [], []
        for k, row in enumerate(order):
            if not k or keys[row] != keys[order[k - 1]]:
                self.ids.append(ids[row])
                self.texts.append(texts[row])
            self.place[row] = len(self.texts) - 1
        self.buffer = np.frombuffer(b" " + b" ".join(self.texts) + b" ", np.uint8)
        blank = IS_BLANK[self.buffer]
        self.low = np.flatnonzero(blank[:-1] & ~blank[1:]) + 1
        self.high = np.flatnonzero(~blank[:-1] & blank[1:]) + 1
        ends = np.cumsum(np.fromiter(map(len, self.texts), np.int64, len(self.texts)) + 1)
        self.starts = np.concatenate([[0], np.searchsorted(self.low, ends)])
        self.sizes = np.diff(self.starts)
        self.doc = np.repeat(np.arange(len(self.texts), dtype=np.int32), self.sizes)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of every word, from sums of its bytes times powers."""
        out = np.zeros(len(self.low), np.uint64)
        forward, back = _powers(BYTE_BASE, SLICE), _powers(int(_power(BYTE_BASE, -1)), SLICE)
        at = 0
        while at < len(out):
            first = self.low[at]
            to = max(at + 1, int(np.searchsorted(self.high, first + SLICE, "right")))
            data = self.buffer[first:self.high[to - 1]]
            if len(data) > len(forward):
                forward, back = _powers(BYTE_BASE, len(data)), _powers(int(_power(BYTE_BASE, -1)), len(data))
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum((data + np.uint64(1)) * forward[:len(data)], out=sums[1:])
            low, high = self.low[at:to] - first, self.high[at:to] - first
            out[at:to] = _mix((sums[high] - sums[low]) * back[low] + (high - low).astype(np.uint64))
            at = to
        return out


def _runs_hash(words: np.ndarray, length: int, base: int) -> np.ndarray:
    """A hash of every run of ``length`` words, built from runs of powers of two."""
    if len(words) < length:
        return np.zeros(0, np.uint64)
    out, covered, run, size = None, 0, words, 1
    while True:
        if length & size:
            out = run if out is None else out[:len(run) - covered] * _power(base, size) + run[covered:]
            covered += size
        if covered == length:
            return _mix(out)
        run = run[:len(run) - size] * _power(base, size) + run[size:]
        size *= 2


def _anchors(shard: Shard, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows that lie in one document, and the place of each one's anchor with its hash."""
    size = min(ANCHOR, length)
    least = _runs_hash(words, size, WORD_BASES[0])
    if len(words) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), least
    at, span, covered = np.arange(len(least)), length - size + 1, 1
    values = least
    while covered < span:  # the least of twice as many runs, the first of equals
        step = min(covered, span - covered)
        later = values[step:] < values[:-step]
        at = np.where(later, at[step:], at[:-step])
        values = np.where(later, values[step:], values[:-step])
        covered += step
    windows = np.flatnonzero(shard.doc[:len(words) - length + 1] == shard.doc[length - 1:])
    return windows, at[windows], least


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def nominate(key: tuple, table: pa.Table, length: int) -> pa.Table:
    release_worker_state()
    shard = Shard(table)
    _, at, least = _anchors(shard, shard.hashes(), length)
    found, counts = np.unique(least[np.unique(at)], return_counts=True)
    return pa.table({"shard": pa.array([key[0].as_py()] * len(found), pa.int64()), "h": _signed(found), "twice": pa.array(counts > 1)})


def _window_hashes(words: np.ndarray, windows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    return (_runs_hash(words, length, WORD_BASES[0])[windows],
            (_runs_hash(words, length, WORD_BASES[1])[windows] >> np.uint64(32)).astype(np.uint32))


def _distinct(h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal pairs are neighbours, first ones first, and where each new pair begins."""
    order = np.argsort(h1, kind="stable")
    h1, h2 = h1[order], h2[order]
    new = np.ones(len(order), bool)
    new[1:] = (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])
    return order, np.flatnonzero(new)


def candidates(table: pa.Table, anchors: pa.Table, length: int) -> pa.Table:
    """The shard's windows of recurring anchors: hashes, least doc_id, whether they stand twice."""
    release_worker_state()
    shard = Shard(table)
    words = shard.hashes()
    windows, at, least = _anchors(shard, words, length)
    windows = windows[np.isin(least, anchors["h"].to_numpy().view(np.uint64))[at]]
    h1, h2 = _window_hashes(words, windows, length)
    order, new = _distinct(h1, h2)
    first, counts = order[new], np.diff(np.append(new, len(order)))
    ids = pa.array(shard.ids, table.schema.field("doc_id").type)
    return pa.table({"h1": _signed(h1[first]), "h2": pa.array(h2[first].view(np.int32)),
                     "doc_id": ids.take(pa.array(shard.doc[windows[first]])), "twice": pa.array(counts > 1)})


def _text(codes: np.ndarray) -> tuple[str, np.ndarray]:
    """Word codes as text, ``WIDTH`` characters a word out of an alphabet for each position,
    and where each word begins in it.  A run of zeros (words of no phrase) is one character."""
    digits = np.stack([codes // BASE ** k % BASE + (1 + BASE * k) for k in range(WIDTH)], axis=1).astype("<u4")
    digits[codes == 0] = 0
    shown = np.repeat((codes > 0)[:, None], WIDTH, axis=1)
    shown[:, 0] |= np.append(True, codes[:-1] > 0)
    return digits[shown].tobytes().decode("utf-32-le"), np.cumsum(shown.sum(axis=1)) - shown.sum(axis=1)


def located(words: list[bytes], doc: np.ndarray, phrases: list[tuple[int, int]], patterns: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """First and last word of every place where one of the ``phrases`` (spans of ``words``) stands
    in a document, by Aho-Corasick automata of at most ``patterns`` phrases each."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    for start, end in phrases:
        for word in words[start:end]:
            numbers.setdefault(word, len(numbers) + 1)
    number = np.fromiter(map(numbers.get, words, repeat(0)), np.int64, len(words))
    place = np.arange(len(words)) + doc  # with a zero after each document
    sequence = np.zeros(len(words) + int(doc[-1]) + 1, np.int64)
    sequence[place] = number
    document = np.zeros(len(sequence), np.int64)
    document[place] = doc
    # as many words as there are codes at most
    patterns = min(patterns, (BASE ** WIDTH - 1) // max((end - start for start, end in phrases), default=1))
    for low in range(0, len(phrases), patterns):
        part = phrases[low:low + patterns]
        used = np.unique(np.concatenate([number[start:end] for start, end in part]))
        code = np.zeros(len(numbers) + 1, np.int64)
        code[used] = np.arange(1, len(used) + 1)
        text, begin = _text(code[sequence])
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        spans = np.array(part)
        for at, size in zip(begin[place[spans[:, 0]]].tolist(), (spans[:, 1] - spans[:, 0]).tolist()):
            automaton.add_word(text[at:at + WIDTH * size], size)
        automaton.make_automaton()
        hits = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
        last = np.searchsorted(begin, hits[:, 0], "right") - 1
        last = last - document[last]
        yield last - hits[:, 1] + 1, last


def _phrases(words: list[bytes], windows: np.ndarray, at: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Spans of neighbouring windows with one anchor, equal ones once: at most 2 x ``length`` - ANCHOR words each."""
    begins = np.append(True, (np.diff(windows) != 1) | (np.diff(at) != 0))
    low, high = windows[begins], windows[np.append(begins[1:], True)] + length
    return list({b" ".join(words[i:j]): (i, j) for i, j in zip(low.tolist(), high.tolist())}.values())


def _found(told: pa.Table, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """For each pair its row in ``told``, or -1."""
    of1, of2 = told["h1"].to_numpy().view(np.uint64), told["h2"].to_numpy().view(np.uint32)
    order = np.lexsort((of2, of1))
    of1, of2 = of1[order], of2[order]
    row = np.searchsorted(of1, h1)
    while True:  # on to the next row of the same first hash, which is rare
        inside = np.minimum(row, len(of1) - 1)
        same = (of1[inside] == h1) & (row < len(of1))
        if not (same & (of2[inside] != h2)).any():
            return np.where(same, order[inside], -1)
        row = row + (same & (of2[inside] != h2))


def cut(table: pa.Table, confirmed: pa.Table, length: int, patterns: int) -> pa.Table:
    """The shard's documents without the words of repeated windows."""
    release_worker_state()
    shard = Shard(table)
    total = len(shard.low)
    covered = np.zeros(total, bool)
    if len(confirmed):
        hashes = shard.hashes()
        windows, at, _ = _anchors(shard, hashes, length)
        h1, h2 = _window_hashes(hashes, np.arange(total - length + 1), length)
        del hashes
        mine = _found(confirmed, h1[windows], h2[windows]) >= 0
        words = [w for text in shard.texts for w in text.split()]
        places = np.zeros(total + 1, np.int64)
        for first, last in located(words, shard.doc, _phrases(words, windows[mine], at[mine], length), patterns):
            places += np.bincount(first, minlength=total + 1) - np.bincount(last - length + 2, minlength=total + 1)
        again = np.flatnonzero(np.cumsum(places)[:-1] > 0)
        # the first place of a window goes free where no smaller doc_id has it
        order, new = _distinct(h1[again], h2[again])
        earliest = order[new]
        row = _found(confirmed, h1[again[earliest]], h2[again[earliest]])
        free = (row >= 0) & confirmed["first"].to_numpy(zero_copy_only=False)[row]
        again = np.delete(again, earliest[free])
        covered = np.cumsum(np.bincount(again, minlength=total + 1) - np.bincount(again + length, minlength=total + 1))[:-1] > 0
    kept, removed = [], []
    for k, text in enumerate(shard.texts):
        out = covered[shard.starts[k]:shard.starts[k + 1]]
        removed.append(int(np.count_nonzero(out)))
        kept.append(b" ".join([w for w, x in zip(text.split(), out.tolist()) if not x] if removed[-1] else text.split()))
    place = shard.place
    result = table.set_column(table.schema.get_field_index("text"), "text", pa.array([kept[p] for p in place], pa.binary()))
    return (result.append_column("n_words", pa.array([int(shard.sizes[p]) for p in place], pa.int64()))
            .append_column("n_removed", pa.array([removed[p] for p in place], pa.int64())))


def in_shards(documents: DataFrame, shard: str, shard_bytes: int) -> tuple[DataFrame, int]:
    """The documents as a table bucketed by ``shard``, a number dealt by the id's hash, and how many there are."""
    spark = documents.sparkSession
    total = documents.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    named = documents.withColumns({"text": F.coalesce(F.col("text"), F.lit("")).cast("binary"), shard: shard_of("doc_id", shards)})
    name = f"passage_docs_{uuid.uuid4().hex}"
    (named.repartition(buckets, shard).write.bucketBy(buckets, shard).option("compression", "zstd")
     .option("path", shared_path(spark, "shards")).saveAsTable(name))
    held = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and ``held`` is bound to them
    return held, shards


def shard_of(doc_id: str, shards: int) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit(12)), F.lit(shards))


def remove_repeats(documents: DataFrame, length: int = 20, shard_bytes: int = 4 << 20, patterns: int = 16_000) -> DataFrame:
    """``documents`` whose ``text`` lost every word of a repeated window of ``length`` words,
    plus ``n_words`` (before) and ``n_removed``."""
    documents = documents.drop("n_words", "n_removed")
    shard = fresh("shard", documents.columns)
    held, shards = in_shards(documents, shard, shard_bytes)
    slim = held.select(F.col(shard).alias("shard"), "doc_id", "text")
    id_type = slim.schema["doc_id"].dataType.simpleString()

    anchors = slim.groupBy("shard").applyInArrow(lambda key, docs: nominate(key, docs, length), "shard long, h long, twice boolean")
    near = Window.partitionBy("h").orderBy("shard")
    recurring = (anchors.withColumn("again", F.col("twice") | F.lag("h").over(near).isNotNull() | F.lead("h").over(near).isNotNull())
                 .where("again").select("shard", "h"))

    windows = (slim.groupBy("shard").cogroup(recurring.groupBy("shard"))
               .applyInArrow(lambda docs, hashes: candidates(docs, hashes, length), f"h1 long, h2 int, doc_id {id_type}, twice boolean"))
    near = Window.partitionBy("h1", "h2").orderBy(F.asc_nulls_first("doc_id"))
    confirmed = (windows.withColumns({"first": F.lag("h1").over(near).isNull(), "last": F.lead("h1").over(near).isNull()})
                 .where("twice OR NOT first OR NOT last").select(shard_of("doc_id", shards).alias("shard"), "h1", "h2", "first"))

    kept = [c for c in held.columns if c != shard]
    schema = ", ".join(f"`{c}` {held.schema[c].dataType.simpleString()}" for c in kept) + ", n_words long, n_removed long"
    out = (held.groupBy(shard).cogroup(confirmed.groupBy("shard"))
           .applyInArrow(lambda docs, told: cut(docs.select(kept), told, length, patterns), schema))
    return out.withColumn("text", F.col("text").cast("string"))
