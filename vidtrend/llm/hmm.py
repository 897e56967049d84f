"""Hidden Markov language model, trained by Baum-Welch over the whole corpus.

Texts are turned into large blocks of word numbers once, in buckets that no later
step moves.  A block's words are dealt by hash into places, where the words of all
blocks meet; what a block and a place tell each other is one row of packed numbers.

Words are counted over all training documents.  The ``emitted`` most frequent are
symbols of their own, known to every task; every other word is emitted as the symbol
of its class (by its ending) and then, within the class, by the state's own
probability of the word.  That comes from the expected (word, state) counts of every
training word, summed in the word's place over all blocks and sent back to those that
hold the word.  They travel as shares of the word's count in half precision; what a
class's words have is added up from the same shares.  A prior of ``PRIOR`` words leads
it to the word's smoothed share of the class's counts, so every word has a probability.  Baum-Welch runs over all training documents: each task adds the
expected counts of its rows, and the sums over all tasks make the next parameters.
The first rounds have the words of a class tied to their shares, the last ``own``
rounds gather every word's counts.  A document's score is the scaled forward
recursion over its whole text.

Training cuts texts into runs of ``RUN`` tokens, each started from the state
distribution found for such starts; scoring never cuts.

Defined results: a null or empty text is its end token alone; without any training
document all counts are zero and every token has probability one; rows are scored
one by one, so repeated rows and ids repeat.  Extra columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, shared_path, small_batches

CLASSES = 256
RUN = 256
#: Text of a block of documents, which a task works on: about five million words, by parts.
BLOCK_BYTES = 32 << 20
#: Tokens that are walked at once.
PART = 1_000_000
#: Slices of the expected counts of symbols and moves, each summed by itself.
HEAD_PARTS = 64
#: A block's words whose probabilities are worked out at once.
WORDS = 1 << 15
PRIOR = 4.0
BLOCKS = ("block long, part int, doc_ids array<string>, held_out array<boolean>, sizes array<int>, codes binary, "
          "place int, words binary, counts binary")
PARTS = "block long, place int, ids binary, counts binary, classes binary, shares binary"


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_class(word: bytes) -> int:
    return zlib.crc32(word[-3:]) % CLASSES


@dataclass(frozen=True)
class Vocabulary:
    """Counts of the corpus that every task needs."""

    head: list[bytes]
    head_count: np.ndarray
    emitted: int
    class_count: np.ndarray
    class_size: np.ndarray
    ends: int
    tokens: int
    distinct: int

    def unigram(self) -> np.ndarray:
        """Counts of all symbols: emitted words, classes, the end."""
        return np.concatenate((self.head_count[:self.emitted], self.class_count, [self.ends])).astype(float)


def most_frequent(table: DataFrame, count: int) -> list:
    """The ``count`` words of ``table`` with the highest ``n``, equal ones by word.  Only words of the
    sixteenths of a doubling in which these lie are sorted, however many parts the table has."""
    table = table.withColumn("step", F.floor(F.log2("n") * 16))
    least, left = None, count
    for r in sorted(table.groupBy("step").agg(F.count("*").alias("words")).collect(), key=lambda r: -r.step):  # a thousand rows at most
        if left <= 0:
            break
        least, left = r.step, left - r.words
    if least is None:
        return []
    return table.where(F.col("step") >= least).orderBy(F.desc("n"), "word").limit(count).collect()


def planes(codes: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte by byte: first all lowest bytes; small numbers compress well so."""
    return np.ascontiguousarray(codes.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def numbers(data: bytes) -> np.ndarray:
    """The numbers of ``planes``."""
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def split_words(texts) -> tuple:
    """The words of an Arrow array of texts, as ``words_of`` has them, in a row; and how many each text has."""
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.string()).fill_null("")))
    words = lists.flatten().cast(pa.binary())
    real = pc.greater(pc.binary_length(words), 0)
    before = np.concatenate(([0], np.cumsum(real.to_numpy(zero_copy_only=False))))
    ends = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
    return words.filter(real), np.diff(before[np.concatenate(([0], ends))])


def together(words, ends: np.ndarray) -> list[bytes]:
    """The words of an Arrow array, those up to each of ``ends`` in one text with spaces between them."""
    import pyarrow as pa
    import pyarrow.compute as pc

    starts = pa.array(np.concatenate(([0], ends)), pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(starts, words), pa.scalar(b" ", pa.binary())).to_pylist()


def apart(texts) -> tuple:
    """The words that ``together`` put into each of ``texts``, which are not empty, as one Arrow array; and how many each has."""
    import pyarrow as pa

    data = np.frombuffer(b" ".join(texts), np.uint8)
    spaces = np.flatnonzero(data == ord(" "))
    offsets = np.concatenate(([0], spaces - np.arange(len(spaces)), [len(data) - len(spaces)])).astype(np.int32)
    count = len(offsets) - 1 if len(texts) else 0
    words = pa.Array.from_buffers(pa.binary(), count, [None, pa.py_buffer(offsets), pa.py_buffer(data[data != ord(" ")])])
    return words, [x.count(b" ") + 1 for x in texts]


def classes_of(words) -> np.ndarray:
    """``word_class`` of each word of an Arrow array; an ending is classed once."""
    import pyarrow.compute as pc

    ends = pc.binary_slice(words, -3).dictionary_encode()
    return np.array([word_class(w) for w in ends.dictionary.to_pylist()], dtype=np.int64)[ends.indices.to_numpy(zero_copy_only=False)]


def sums_by(numbers_in: np.ndarray, rows: np.ndarray, size: int, onto: np.ndarray | None = None) -> np.ndarray:
    """The rows added up by number, which is below ``size``; with ``onto``, added to what that has."""
    total = np.zeros((rows.shape[1], size)).T if onto is None else onto
    for h in range(rows.shape[1]):
        total[:, h] += np.bincount(numbers_in, rows[:, h], size)
    return total


def parts_of(ends: np.ndarray, part: int) -> list[tuple[int, int]]:
    """Texts that end so, in parts of about ``part`` tokens: the first of each and the first behind it."""
    cuts = [0, *(np.flatnonzero(np.diff(ends // part)) + 1).tolist(), len(ends)]
    return list(zip(cuts, cuts[1:]))


def block_rows(number: int, batches: list, places: int):
    """A block's rows of ``blocks_of``."""
    import pyarrow as pa

    dictionaries, indices, sizes = [], [], []
    for batch in batches:
        words, count = split_words(batch.column("text"))
        coded = words.dictionary_encode()
        dictionaries.append(coded.dictionary)
        indices.append(coded.indices.to_numpy(zero_copy_only=False))
        sizes.append(count + 1)
    every = pa.concat_arrays(dictionaries).dictionary_encode()
    of, at = every.indices.to_numpy(zero_copy_only=False), 0
    for k, d in enumerate(dictionaries):
        indices[k], at = of[at:at + len(d)][indices[k]], at + len(d)
    codes, sizes = np.concatenate(indices), np.concatenate(sizes)
    # the most frequent words first; number 0 is the end of a text
    order = np.argsort(-np.bincount(codes, minlength=len(every.dictionary)), kind="stable")
    rank = np.empty(len(order), np.uint32)
    rank[order] = np.arange(1, len(order) + 1)
    stops = np.cumsum(sizes)
    codes = np.insert(rank[codes], stops - np.arange(1, len(sizes) + 1), 0)
    words = every.dictionary.take(pa.array(order))
    doc_ids = [i for b in batches for i in b.column("doc_id").to_pylist()]
    held_out = [h for b in batches for h in b.column("held_out").to_pylist()]
    learned = np.repeat([h is not None and not h for h in held_out], sizes)
    counts = np.bincount(codes[learned], minlength=len(words) + 1)[1:]
    named = together(words, np.array([len(words)]))[0].split(b" ") if len(words) else []
    place = np.fromiter((zlib.crc32(w) % places for w in named), np.int64, len(words))
    for k, (i, j) in enumerate(parts_of(stops, PART)):
        part = codes[stops[i] - sizes[i]:stops[j - 1]]
        yield [number, k, doc_ids[i:j], held_out[i:j], sizes[i:j].tolist(), planes(part), -1, b"", b""]
    sorted_by = np.argsort(place, kind="stable")
    ends = np.cumsum(np.bincount(place, minlength=places))
    for p, (i, j, text) in enumerate(zip([0, *ends], ends, together(words.take(pa.array(sorted_by)), ends))):
        if i < j:
            own = sorted_by[i:j]
            yield [number, -1, [], [], [], planes(own), p, text, planes(counts[own])]


def blocks_of(documents: DataFrame) -> DataFrame:
    """Blocks of about ``BLOCK_BYTES`` of text, written in buckets of whole blocks.  Rows of
    texts (block, part from 0, doc_ids, held_out, sizes, codes): the words as numbers from 1
    in the block, 0 for the end of a text.  Rows of the block's words by the hash of the word
    (block, part -1, codes, place, words, counts): the words less 1, how often each is learned from."""
    spark = documents.sparkSession
    small_batches(spark, 250)
    size = documents.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // BLOCK_BYTES))
    places = 2 * parts

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        number, waiting, held = TaskContext.get().partitionId() << 32, [], 0
        names = ["block", "part", "doc_ids", "held_out", "sizes", "codes", "place", "words", "counts"]
        kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.int32(),
                 pa.binary(), pa.binary()]

        def done():
            for row in block_rows(number, waiting, places):
                yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds)], names=names)

        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(batch)
            held += batch.column("text").nbytes
            if held >= 1.5 * BLOCK_BYTES:
                yield from done()
                number, waiting, held = number + 1, [], 0
        if waiting:
            yield from done()
        pa.default_memory_pool().release_unused()

    # ids pass through as text; few large blocks, as a word is sent once for each block that has it
    coded = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "held_out", "text").coalesce(parts).mapInArrow(run, BLOCKS)
    name = f"hmm_blocks_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (coded.write.bucketBy(buckets, "block").option("compression", "zstd")
     .option("path", shared_path(spark, "blocks")).saveAsTable(name))
    blocks = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the entry; the files stay
    return blocks


def slots_of(blocks: DataFrame, emitted: int) -> DataFrame:
    """The training counts of all words, added up over the blocks.  Rows (block, place, ids, n):
    for a block's words of a place, in their order there, the word's number in the place and its
    count.  And one row of each place for block -1: its ``emitted`` most frequent words with
    their counts, and (classes) the sums of counts and of words by class."""

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        import pyarrow as pa

        rows = rows.sort_values("block")
        every, sizes = apart(rows["words"])
        coded = every.dictionary_encode()
        ids, words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        n = np.bincount(ids, np.concatenate([numbers(x) for x in rows["counts"]]), len(words)).astype(np.int64)
        place, out, at = int(rows["place"].iloc[0]), [], 0
        for block, size in zip(rows["block"], sizes):
            own = ids[at:at + size]
            at += size
            out.append([block, place, planes(own), n[own].tobytes(), b"", b""])
        seen = np.flatnonzero(n)
        k = classes_of(words.take(pa.array(seen)))
        sums = np.stack((np.bincount(k, n[seen], CLASSES), np.bincount(k, minlength=CLASSES))).astype(np.int64)
        if 0 < emitted < len(seen):
            seen = seen[n[seen] >= np.partition(n[seen], -emitted)[-emitted]]
        top = sorted(zip((-n[seen]).tolist(), words.take(pa.array(seen)).to_pylist()))[:emitted]
        out.append([-1, place, b"", np.array([-c for c, _ in top], dtype=np.int64).tobytes(), b" ".join([w for _, w in top]), sums.tobytes()])
        return pd.DataFrame(out, columns=["block", "place", "ids", "n", "words", "classes"])

    words = blocks.where("part = -1").select("block", "place", "words", "counts")
    return keep(words.groupBy("place").applyInPandas(add, "block long, place int, ids binary, n binary, words binary, classes binary"), "slots")


def vocabulary_of(slots: DataFrame, ends: int, emitted: int) -> Vocabulary:
    """The counts of the corpus, with ``ends`` texts, from ``slots_of``."""
    places = slots.where("block = -1")

    def tops(batches):
        for pdf in batches:
            for words, n in zip(pdf["words"], pdf["n"]):
                n = np.frombuffer(n, np.int64)
                yield pd.DataFrame({"word": words.split(b" ")[:len(n)], "n": n})

    def by_class(batches):
        total = np.zeros((2, CLASSES), dtype=np.int64)
        for pdf in batches:
            for x in pdf["classes"]:
                total += np.frombuffer(x, np.int64).reshape(2, CLASSES)
        yield pd.DataFrame({"class": np.arange(CLASSES), "n": total[0], "size": total[1]})

    table = places.select("words", "n").mapInPandas(tops, "word binary, n long")
    top = most_frequent(table, emitted)
    names = [bytes(r.word) for r in top]
    counts = np.array([r.n for r in top], dtype=np.int64)
    emitted = min(emitted, len(names))
    of_class, size = np.zeros(CLASSES, dtype=np.int64), np.zeros(CLASSES, dtype=np.int64)
    sums = places.select("classes").mapInPandas(by_class, "class int, n long, size long")
    for r in sums.groupBy("class").agg(F.sum("n").alias("n"), F.sum("size").alias("size")).collect():
        of_class[r["class"]], size[r["class"]] = r.n, r["size"]
    tokens, distinct = int(of_class.sum()) + ends, int(size.sum()) + (ends > 0)
    for word, n in zip(names[:emitted], counts):  # emitted words are not in their class
        of_class[word_class(word)] -= n
        size[word_class(word)] -= 1
    return Vocabulary(names, counts, emitted, of_class, size, ends, tokens, distinct)


def with_columns(documents: DataFrame) -> DataFrame:
    """(doc_id, text, held_out); without ``held_out`` all are learned from."""
    missing = {c: v for c, v in (("doc_id", F.lit(None).cast("long")), ("held_out", F.lit(False))) if c not in documents.columns}
    return documents.withColumns(missing).select("doc_id", "text", "held_out")


def count_words(documents: DataFrame, emitted: int = 1 << 13) -> Vocabulary:
    """Count the words of ``documents`` that are learned from."""
    documents = with_columns(documents)
    return vocabulary_of(slots_of(blocks_of(documents), emitted), documents.where("not held_out").count(), emitted)


def encode(documents: DataFrame, vocabulary: Vocabulary) -> tuple[DataFrame, DataFrame]:
    """``blocks_of`` and ``slots_of`` the documents of which ``vocabulary`` has the counts."""
    blocks = blocks_of(with_columns(documents))
    return blocks, slots_of(blocks, vocabulary.emitted).where("block >= 0").select("block", "place", "ids", "n")


@dataclass(frozen=True)
class Hmm:
    """start (H), later (H): state distribution at the start of a text and of a later
    run; move (H x H); emit (symbols x H)."""

    start: np.ndarray
    later: np.ndarray
    move: np.ndarray
    emit: np.ndarray


def initial(unigram: np.ndarray, states: int, seed: int) -> Hmm:
    """States that tend to stay, and whose emissions differ from the corpus at random."""
    rng = np.random.default_rng(seed)
    emit = (unigram[:, None] + 0.01) * rng.uniform(0.5, 1.5, (len(unigram), states))
    move = np.full((states, states), 0.2 / max(1, states - 1))
    np.fill_diagonal(move, 0.8 if states > 1 else 1.0)
    even = np.full(states, 1.0 / states)
    return Hmm(even, even, move / move.sum(1, keepdims=True), emit / emit.sum(0))


def lockstep(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs to be walked side by side, longest first: all symbols in a row, the place of
    each run's first, how many runs are alive at each step, and the runs' order."""
    size = np.array([len(r) for r in runs])
    order = np.argsort(-size, kind="stable")
    size = size[order]
    start = np.concatenate(([0], np.cumsum(size)[:-1]))
    alive = np.searchsorted(-size, -np.arange(size[0]), side="left")
    return np.concatenate([runs[k] for k in order], dtype=np.int32, casting="unsafe"), start, alive, order


def across(a: np.ndarray) -> np.ndarray:
    """The sum of each row, added up column by column in pairs, as numpy adds eight: its own sum
    along an axis as short as the states takes several times as long."""
    columns = list(a.T)
    while len(columns) > 1:
        columns = [sum(columns[k + 1:k + 2], columns[k]) for k in range(0, len(columns), 2)]
    return columns[0] if a.shape[1] > 1 else columns[0].copy()


def expected_counts(model: Hmm, runs: list[np.ndarray], first: np.ndarray, emits: np.ndarray | None = None):
    """Baum-Welch sums over runs of symbols: (start, later, move, emit); ``first`` marks runs
    that start a text.  With ``emits``, those of emit are added to what that has."""
    states, symbols = model.move.shape[0], len(model.emit)
    flat, place, alive, order = lockstep(runs)
    first = first[order]
    emit, move = model.emit.astype(np.float32, copy=False), model.move.astype(np.float32)
    # all that is kept of the steps lies in a row, the last step first; rows are picked by take(), which is
    # several times as fast as an index
    behind = len(flat) - np.cumsum(alive)
    steps = [slice(at, at + n) for n, at in zip(alive, behind)]
    token, scale, forward = np.empty(len(flat), dtype=np.intp), np.empty(len(flat), np.float32), np.empty((len(flat), states), np.float32)
    a = np.where(first[:, None], model.start, model.later).astype(np.float32)
    for t, (n, step) in enumerate(zip(alive, steps)):
        token[step] = flat[place[:n] + t]
        a = np.multiply(a if t == 0 else a[:n] @ move, emit.take(token[step], axis=0), out=forward[step])
        c = np.add(across(a), np.float32(1e-30), out=scale[step])
        a /= c[:, None]
    moves = np.zeros((states, states))
    back = np.ones((alive[-1], states), dtype=np.float32)
    for t in range(len(alive) - 1, -1, -1):
        n, step = alive[t], steps[t]
        if len(back) < n:
            back = np.concatenate((back, np.ones((n - len(back), states), dtype=np.float32)))
        g = forward[step]  # from here on the step's posterior
        g *= back
        g /= (across(g) + np.float32(1e-30))[:, None]
        if t:
            back *= emit.take(token[step], axis=0)
            back /= scale[step][:, None]
            moves += forward[steps[t - 1]][:n].T @ back
            back = back @ move.T
    opening = forward[steps[0]]
    return opening[first].sum(0), opening[~first].sum(0), moves * model.move, sums_by(token, forward, symbols, emits)


def log_likelihood(model: Hmm, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each whole text, by the scaled forward recursion."""
    flat, place, alive, order = lockstep(texts)
    total = np.zeros(len(texts))
    a = np.tile(model.start, (len(texts), 1))
    for t, n in enumerate(alive):
        a = (a[:n] if t == 0 else a[:n] @ model.move) * model.emit.take(flat[place[:n] + t], axis=0)
        c = across(a)
        a /= c[:, None]
        total[:n] += np.log10(c)
    out = np.empty(len(texts))
    out[order] = total
    return out


def runs_of(symbols: np.ndarray, sizes) -> tuple[list[np.ndarray], np.ndarray]:
    """A block's texts in runs, and which of them start a text."""
    runs, first, place = [], [], 0
    for size in sizes:
        for at in range(0, size, RUN):
            runs.append(symbols[place + at:place + min(size, at + RUN)])
            first.append(at == 0)
        place += size
    return runs, np.array(first)


def within_class(slots: pd.DataFrame, names: list[str], of_state: np.ndarray, count: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Each state's probability of each slot's word within its class.  ``of_state`` are the expected
    (class, state) counts, ``count`` and ``size`` the training words and distinct words of a class."""
    k = slots["class"].to_numpy(dtype=np.int64)
    share = ((slots["n"].to_numpy(dtype=float) + 1) / (count[k] + size[k] + 1))[:, None]
    own = slots[names].to_numpy(dtype=float, na_value=0.0)
    prior = PRIOR * ((size + 1) / np.maximum(count, 1))[k][:, None] * of_state[k]
    total = of_state[k] + prior
    return np.where(total > 1e-9, (own + prior * share) / np.maximum(total, 1e-9), share)


@dataclass(frozen=True)
class Block:
    """A block.  ``texts``: the rows of its texts by part, as Arrow has them (doc_ids, held_out, sizes,
    codes); ``symbol``: the symbol of each of its numbers.  ``classes`` and ``counts`` are those of its
    own words, the words outside the emitted ones by place, whose symbols follow all others in this order;
    ``ranks`` (place, and which of the place's words these are) say where to find them."""

    texts: list[tuple]
    symbol: np.ndarray
    classes: np.ndarray
    counts: np.ndarray
    ranks: list[tuple[int, np.ndarray]]

    def parts(self):
        """The texts (doc_ids, held_out, sizes, symbols in a row), of which one part is held at a time."""
        for doc_ids, held_out, sizes, codes in self.texts:
            yield doc_ids.as_py(), held_out.as_py(), np.array(sizes.as_py(), dtype=np.int64), self.symbol[numbers(codes.as_buffer())]


def read_block(rows, head: list[bytes], tied: bool = False) -> Block:
    """The block of its rows, an Arrow table; ``tied``: words outside the emitted ones are their class's symbol."""
    import pyarrow as pa
    import pyarrow.compute as pc

    part, place = rows["part"].to_numpy(), rows["place"].to_numpy()
    order, emitted = np.lexsort((place, part)), len(head)
    words = order[part[order] < 0]
    of = {c: list(rows[c]) for c in ("doc_ids", "held_out", "sizes", "codes", "words", "counts")}
    texts = [tuple(of[c][k] for c in ("doc_ids", "held_out", "sizes", "codes")) for k in order[len(words):]]
    names, sizes = apart([of["words"][k].as_py() for k in words])
    codes, n = (np.concatenate([np.zeros(0, np.int64), *(numbers(of[c][k].as_buffer()) for k in words)]) for c in ("codes", "counts"))
    found = pc.index_in(names, value_set=pa.array(head, pa.binary())).fill_null(-1).to_numpy(zero_copy_only=False)
    rest = np.flatnonzero(found < 0)
    classes = classes_of(names.take(pa.array(rest)))
    symbol = np.zeros(1 + len(codes), dtype=np.uint32)
    symbol[0] = emitted + CLASSES
    symbol[codes + 1] = found
    symbol[codes[rest] + 1] = emitted + classes if tied else emitted + CLASSES + 1 + np.arange(len(rest))
    ends = np.cumsum(sizes, dtype=np.int64)
    cuts = np.searchsorted(rest, ends)
    ranks = [(int(p), rest[i:j] - (end - size)) for p, i, j, end, size in zip(place[words], [0, *cuts], cuts, ends, sizes)]
    return Block(texts, symbol, classes, n[rest], ranks)


def halves(share: np.ndarray) -> bytes:
    """Shares of the states but the last, in half precision; all of a row add up to one."""
    return share[:, :-1].astype("<f2").tobytes()


def shares(data: bytes, words: int, states: int) -> np.ndarray:
    """The shares of ``halves``."""
    first = np.frombuffer(data, "<f2").reshape(words, states - 1).astype(float)
    return np.concatenate((first, np.maximum(0.0, 1.0 - first.sum(1, keepdims=True))), axis=1)


def known_words(block: Block, found) -> tuple[np.ndarray, list[np.ndarray], dict]:
    """The training counts of the block's own words and their numbers in each place, from the block's
    rows of ``slots_of``; and, where there are any, the places' counts by state (see ``halves``)."""
    places = found["place"].to_pylist()
    ids, n, by_state = ({p: x.as_buffer() for p, x in zip(places, found[c]) if x.is_valid} for c in ("ids", "n", "shares"))
    counts = [np.frombuffer(n[p], np.int64)[k] for p, k in block.ranks]
    return np.concatenate([np.zeros(0, np.int64), *counts]), [numbers(ids[p])[k] for p, k in block.ranks], by_state


def with_words(model: Hmm, block: Block, n: np.ndarray, by_state: dict, of_state: np.ndarray, count: np.ndarray, size: np.ndarray,
               kind=float) -> Hmm:
    """The model with a block's own words as further symbols, which have the probability of their class
    times their own within it; see ``known_words`` and ``within_class``.  About ``WORDS`` words are worked
    out at once, as the steps between are as large as the result.  ``kind`` is that of the emissions."""
    symbols, states = model.emit.shape
    names, first = [f"h{k}" for k in range(states)], symbols - 1 - CLASSES
    emit = np.empty((symbols + len(n), states), dtype=kind)
    emit[:symbols] = model.emit
    ends = np.cumsum([len(k) for _, k in block.ranks], dtype=np.int64)
    for i, j in parts_of(ends, WORDS):
        if i == j:
            continue
        part = slice(ends[i] - len(block.ranks[i][1]), ends[j - 1])
        own = np.zeros((part.stop - part.start, states))
        if by_state:
            own = n[part, None] * np.concatenate([shares(by_state[p], len(k), states) for p, k in block.ranks[i:j]])
        words = pd.DataFrame(own, columns=names).assign(**{"class": block.classes[part], "n": n[part]})
        emit[symbols:][part] = model.emit[first + block.classes[part]] * within_class(words, names, of_state, count, size)
    return Hmm(model.start, model.later, model.move, emit)


def with_counts(slots: DataFrame, counts: DataFrame | None) -> DataFrame:
    """The rows of both, for the blocks they belong to."""
    none = F.lit(None).cast("binary")
    slots = slots.select("block", "place", "ids", "n", none.alias("shares"))
    return slots if counts is None else slots.unionByName(counts.select("block", "place", none.alias("ids"), none.alias("n"), "shares"))


def learned_runs(block: Block):
    """The runs of a block's texts that are not held out, part by part; see ``runs_of``."""
    for _, held_out, sizes, symbols in block.parts():
        learned = np.array([h is not None and not h for h in held_out], dtype=bool)
        if learned.any():
            yield runs_of(symbols[np.repeat(learned, sizes)], sizes[learned].tolist())


def train(blocks: DataFrame, slots: DataFrame, vocabulary: Vocabulary, states: int = 8, rounds: int = 6, own: int = 2,
          seed: int = 5) -> tuple[Hmm, DataFrame | None, np.ndarray]:
    """Baum-Welch over all texts that are not held out: the model, the expected counts of all
    other words (block, place, shares: see ``halves``), and those of the classes."""
    unigram = vocabulary.unigram()
    model, symbols, emitted = initial(unigram, states, seed), len(unigram), vocabulary.emitted
    spark = blocks.sparkSession
    small_batches(spark, 10_000)
    rows, cut = symbols + states + 2, -(-(symbols + states + 2) // HEAD_PARTS)
    counts, of_state = None, np.zeros((CLASSES, states))
    for turn in range(rounds):
        tied = turn < rounds - own
        shared = spark.sparkContext.broadcast((model.start, model.later, model.move, model.emit, of_state, vocabulary.class_count,
                                               vocabulary.class_size, vocabulary.head[:emitted]))

        def step(rows_in, found, shared=shared, tied=tied):
            import pyarrow as pa

            *values, head = shared.value
            model, block = Hmm(*values[:4]), read_block(rows_in, head, tied)
            if not tied:
                n, ids, by_state = known_words(block, found)
                model = with_words(model, block, n, by_state, *values[4:], kind=np.float32)
            total, emits = np.zeros((rows, states)), np.zeros((states, len(model.emit))).T
            for texts, first in learned_runs(block):
                start, later, move, _ = expected_counts(model, texts, first, emits)
                total[symbols:] += np.concatenate((move, [start, later]))
            word = emits[symbols:]
            total[:symbols] = emits[:symbols]
            if not tied:
                total[emitted:emitted + CLASSES] += sums_by(block.classes, word, CLASSES)
            number = rows_in["block"][0].as_py()
            out = [[number, -1 - k, b"", b"", b"", total[k * cut:(k + 1) * cut].tobytes()] for k in range(HEAD_PARTS) if k * cut < rows]
            at = 0
            for (place, k), own_ids in zip(block.ranks, [] if tied else ids):
                part = slice(at, at + len(k))
                at += len(k)
                share = word[part] / np.maximum(across(word[part])[:, None], 1e-30)
                out.append([number, place, planes(own_ids), planes(block.counts[part]), block.classes[part].astype(np.uint8).tobytes(), halves(share)])
            kinds = {"block": pa.int64(), "place": pa.int32(), "ids": pa.binary(), "counts": pa.binary(), "classes": pa.binary(), "shares": pa.binary()}
            return pa.table([pa.array(x, k) for x, k in zip(zip(*out), kinds.values())], names=list(kinds))

        def add(got: pd.DataFrame) -> pd.DataFrame:
            place, got = int(got["place"].iloc[0]), got.sort_values("block")
            if place < 0:
                total = np.sum([np.frombuffer(x) for x in got["shares"]], axis=0)
                return pd.DataFrame([[-1, place, total.tobytes()]], columns=["block", "place", "shares"])
            ids, n = [numbers(x) for x in got["ids"]], np.concatenate([numbers(x) for x in got["counts"]]).astype(float)
            every, part = np.concatenate(ids), np.concatenate([shares(x, len(i), states) for x, i in zip(got["shares"], ids)])
            size = int(every.max()) + 1 if len(every) else 0
            of = np.zeros(size)
            np.add.at(of, every, n)
            total = sums_by(every, part * n[:, None], size)
            total /= np.maximum(across(total)[:, None], 1e-30)
            kept = shares(halves(total), size, states) * of[:, None]  # as the blocks will read it
            kind = np.zeros(size, dtype=np.int64)
            kind[every] = np.concatenate([np.frombuffer(x, np.uint8) for x in got["classes"]])
            sums = sums_by(kind, kept, CLASSES)
            out = [[b, place, halves(total[i])] for b, i in zip(got["block"], ids)]
            return pd.DataFrame([*out, [-1, place, sums.tobytes()]], columns=["block", "place", "shares"])

        by_block = blocks.groupBy("block")
        if tied:
            parts = by_block.applyInArrow(lambda rows_in: step(rows_in, None), PARTS)
        else:
            parts = by_block.cogroup(with_counts(slots, counts).groupBy("block")).applyInArrow(lambda rows_in, found: step(rows_in, found), PARTS)
        sums = keep(parts.groupBy("place").applyInPandas(add, "block long, place int, shares binary"), "word-states")
        found = {r.place: np.frombuffer(bytes(r.shares)) for r in sums.where("block = -1").collect()}  # model and classes: few numbers
        if not found:
            return model, None, of_state
        total = np.concatenate([found[p] for p in sorted((p for p in found if p < 0), reverse=True)]).reshape(rows, states)
        if not total.any():
            return model, None, of_state
        emit = total[:symbols] + 0.01 * (unigram + 1.0)[:, None] / (unigram + 1.0).sum() * total[:symbols].sum(0)
        move, start, later = total[symbols:-2] + 0.1, total[-2] + 0.1, total[-1] + 0.1
        model = Hmm(start / start.sum(), later / later.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(0))
        if not tied:
            counts = sums.where("block >= 0")
            of_state = sum((x.reshape(CLASSES, states) for p, x in found.items() if p >= 0), np.zeros((CLASSES, states)))
        shared.unpersist()
    return model, counts, of_state


def score(documents: DataFrame, emitted: int = 1 << 13, states: int = 8, rounds: int = 6) -> DataFrame:
    """Score every row of ``documents`` (doc_id, text, held_out); the rows with ``held_out``
    false are learned from.  Result: (doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score), the scores as log10 probabilities of the add-one unigram model and
    of the hidden Markov model."""
    spark = documents.sparkSession
    documents = with_columns(documents)
    blocks = blocks_of(documents)
    every = slots_of(blocks, emitted)
    v = vocabulary_of(every, documents.where("not held_out").count(), emitted)
    slots = every.where("block >= 0").select("block", "place", "ids", "n")
    model, counts, of_state = train(blocks, slots, v, states, rounds)
    first = np.concatenate((v.head_count[:v.emitted], np.zeros(CLASSES, dtype=np.int64), [v.ends]))
    shared = spark.sparkContext.broadcast((model.start, model.later, model.move, model.emit, of_state, v.class_count, v.class_size,
                                           v.head[:v.emitted], first))
    each = float(np.log10(v.tokens + v.distinct + 1))

    def run(rows, found):
        import pyarrow as pa

        *values, head, first = shared.value
        block = read_block(rows, head)
        n, _, by_state = known_words(block, found)
        model = with_words(Hmm(*values[:4]), block, n, by_state, *values[4:])
        n = np.concatenate((first, n))
        known, base, out = (n > 0).astype(np.int64), np.log10(n + 1.0), []
        for doc_ids, held_out, sizes, symbols in block.parts():
            starts = np.cumsum(sizes) - sizes
            out.append(pa.table({
                "doc_id": pa.array(doc_ids, pa.string()), "held_out": pa.array(held_out, pa.bool_()), "n_tokens": sizes,
                "n_known": np.add.reduceat(known[symbols], starts), "base_score": np.add.reduceat(base[symbols], starts) - sizes * each,
                "score": log_likelihood(model, np.split(symbols, starts[1:]))}))
        return pa.concat_tables(out)

    scored = blocks.groupBy("block").cogroup(with_counts(slots, counts).groupBy("block")).applyInArrow(
        run, "doc_id string, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out", "n_tokens", "n_known",
                         F.lit(v.tokens).cast("long").alias("train_tokens"), "base_score",
                         (F.lit(0.0) if v.tokens == 0 else F.col("score")).alias("score"))
