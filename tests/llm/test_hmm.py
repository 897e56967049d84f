from __future__ import annotations

import itertools
import math
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from vidtrend.llm import hmm
from vidtrend.llm.queries import op8_language_model

SF = "/root/testdata/sf0.01"


def test_forward_equals_the_sum_over_all_state_paths():
    rng = np.random.default_rng(0)
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    model = hmm.Hmm(norm(rng.random(3), 0), norm(rng.random(3), 0), norm(rng.random((3, 3)), 1), norm(rng.random((5, 3)), 0))
    texts = [rng.integers(0, 5, n) for n in (1, 4, 6, 2)]
    for text, got in zip(texts, hmm.log_likelihood(model, texts)):
        total = 0.0
        for path in itertools.product(range(3), repeat=len(text)):
            p = model.start[path[0]] * model.emit[text[0], path[0]]
            for a, b, s in zip(path, path[1:], text[1:]):
                p *= model.move[a, b] * model.emit[s, b]
            total += p
        assert math.isclose(got, math.log10(total), rel_tol=1e-9)


def test_expected_counts_equal_enumeration():
    rng = np.random.default_rng(2)
    norm = lambda a, axis: a / a.sum(axis=axis, keepdims=True)
    model = hmm.Hmm(norm(rng.random(2), 0), norm(rng.random(2), 0), norm(rng.random((2, 2)), 1), norm(rng.random((4, 2)), 0))
    runs, first = [rng.integers(0, 4, n) for n in (5, 1, 3)], np.array([True, False, True])
    want = [np.zeros(2), np.zeros(2), np.zeros((2, 2)), np.zeros((4, 2))]
    for run, opens in zip(runs, first):
        begin, paths = (model.start if opens else model.later), []
        for path in itertools.product(range(2), repeat=len(run)):
            p = begin[path[0]] * model.emit[run[0], path[0]]
            for a, b, s in zip(path, path[1:], run[1:]):
                p *= model.move[a, b] * model.emit[s, b]
            paths.append((path, p))
        total = sum(p for _, p in paths)
        for path, p in paths:
            want[0 if opens else 1][path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want[2][a, b] += p / total
            for s, h in zip(run, path):
                want[3][s, h] += p / total
    for a, b in zip(hmm.expected_counts(model, runs, first), want):
        assert np.allclose(a, b, atol=1e-4)


def base(rows):
    """The contract's counts and base score, in plain Python."""
    held = {i: zlib.crc32(str("" if i is None else i).encode()) % 7 == 2 for i, _ in rows}
    counts = Counter()
    for i, text in rows:
        if not held[i]:
            counts.update(hmm.words_of(text) + [None])
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        tokens = hmm.words_of(text) + [None]
        out.append((i, held[i], len(tokens), sum(counts[t] > 0 for t in tokens), n,
                    round(sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens), 6)))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in df.collect()), key=str)


def test_base_score_and_held_out_gain(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = op8_language_model(spark, SF).cache()
    assert digest(got) == base(rows)
    held = got.where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert held[0] > held[1]


def test_edges_small_vocabularies_and_empty_table(spark, edge, empty):
    from vidtrend.llm.common import crc_mod

    docs = edge.withColumn("held_out", crc_mod(F.col("doc_id"), 7) == 2).withColumn("row", F.lit("x")).withColumn("word", F.lit(1))
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    for emitted in (1 << 13, 5):  # with few known words the rest come by the join
        got = hmm.score(docs, emitted=emitted, states=3, rounds=2).cache()
        assert digest(got) == base(rows)
        assert got.where("score IS NULL OR score > 0 OR isnan(score)").count() == 0
    assert hmm.score(empty.withColumn("held_out", F.lit(False))).count() == 0
    alone = hmm.score(docs.withColumn("held_out", F.lit(True)))
    assert {(r.n_known, r.train_tokens, r.base_score, r.score) for r in alone.collect()} == {(0, 0, 0.0, 0.0)}


def test_probabilities_of_all_continuations_add_up(spark):
    """All sequences of one symbol, and all of two, are distributions under the trained model."""
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(["a b", "b c c", "a", "d e"])], "doc_id long, text string")
    learned = docs.withColumn("held_out", F.lit(False))
    vocabulary = hmm.count_words(docs, emitted=2)
    assert vocabulary.tokens == 12 and vocabulary.distinct == 6 and vocabulary.unigram().sum() == 12
    assert hmm.score(learned, emitted=2).count() == 4
    blocks, slots = hmm.encode(learned, vocabulary)
    model, _, _ = hmm.train(blocks, slots, vocabulary, states=3, rounds=3)
    symbols = range(len(model.emit))
    assert abs((10 ** hmm.log_likelihood(model, [np.array([x]) for x in symbols])).sum() - 1) < 1e-9
    pairs = [np.array([x, y]) for x in symbols for y in symbols]
    assert len(pairs) == 259 ** 2 and abs((10 ** hmm.log_likelihood(model, pairs)).sum() - 1) < 1e-9


def test_words_outside_the_emitted_ones_learn_their_states(spark):
    """Two equally frequent words of one class, each in its own kind of text."""
    rows = [(k, ("a a xaing a a " if k % 2 else "b b xbing b b ") * 8, False) for k in range(80)]
    rows += [(100, "a a xaing a a", True), (101, "a a xbing a a", True), (102, "b b xbing b b", True), (103, "b b xaing b b", True)]
    got = hmm.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean"), emitted=2, states=2)
    score = {r.doc_id: r.score for r in got.collect()}
    assert hmm.word_class(b"xaing") == hmm.word_class(b"xbing") and len(score) == 84
    assert score[100] > score[101] + 0.2 and score[102] > score[103] + 0.2


def test_probabilities_within_a_class_add_up():
    import pandas as pd

    rng = np.random.default_rng(4)
    words = pd.DataFrame({"class": [0, 0, 0, 1, 1], "n": [3, 1, 0, 2, 0]})  # a class's unseen words are one
    own = rng.random((5, 2)) * words[["n"]].to_numpy()
    words[["h0", "h1"]] = own
    of_state = np.stack([own[:3].sum(0), own[3:].sum(0)])
    got = hmm.within_class(words, ["h0", "h1"], of_state, np.array([4, 2]), np.array([2, 1]))
    assert np.allclose(got[:3].sum(0), 1) and np.allclose(got[3:].sum(0), 1)


def test_classes_are_counted_as_words_are_classed(spark):
    texts = ["a bb ccc dddd été x" * 3, "a étés bb", "zz zz zzz aa"]
    vocabulary = hmm.count_words(spark.createDataFrame([(t,) for t in texts], "text string"), emitted=0)
    want, size = np.zeros(hmm.CLASSES), np.zeros(hmm.CLASSES)
    for word, n in Counter(w for t in texts for w in hmm.words_of(t)).items():
        want[hmm.word_class(word)] += n
        size[hmm.word_class(word)] += 1
    assert (vocabulary.class_count == want).all() and (vocabulary.class_size == size).all()


def test_most_frequent_words(spark):
    rows = [(b"w%03d" % k, 1 + k * k % 97) for k in range(300)]
    table = spark.createDataFrame(rows, "word binary, n long").repartition(5)
    want = sorted(rows, key=lambda r: (-r[1], r[0]))
    for count in (0, 1, 40, 299, 300, 400):
        assert [(bytes(r.word), r.n) for r in hmm.most_frequent(table, count)] == want[:count]
    assert hmm.most_frequent(table.limit(0), 5) == []


def test_blocks_stay_where_they_are_and_only_counts_move(spark, capsys):
    rows = [(k, f"a b c{k} a", k % 3 == 0) for k in range(30)]
    hmm.score(spark.createDataFrame(rows, "doc_id long, text string, held_out boolean"), emitted=2, states=2, rounds=3).explain()
    assert capsys.readouterr().out.count("Exchange hashpartitioning(block") == 1  # of the counts; that of the texts' blocks is gone


def test_scores_do_not_depend_on_the_blocks(spark, monkeypatch):
    rows = [(k, " ".join(f"w{(k * 7 + j * j) % 90} the" for j in range(5 + k % 40)) if k % 11 else None, k % 5 == 0) for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean").repartition(3)
    monkeypatch.setattr(hmm, "PART", 300)
    found = []
    for size in (1 << 20, 1 << 11):
        monkeypatch.setattr(hmm, "BLOCK_BYTES", size)
        assert hmm.blocks_of(docs).select("block").distinct().count() == (1 if size == 1 << 20 else 3)
        found.append({r.doc_id: r for r in hmm.score(docs, emitted=20, states=3, rounds=4).collect()})
    one, many = found
    assert len(one) == len(many) == 120
    for k, r in one.items():
        assert r[:5] == many[k][:5] and math.isclose(r.base_score, many[k].base_score, rel_tol=1e-9)
        assert math.isclose(r.score, many[k].score, rel_tol=2e-3)


def test_words_in_a_row_are_the_words_of_each_text():
    import pyarrow as pa

    texts = ["A  b\tÉCOLE\x0b c\n", None, "", " \t\r\n", "x\x1cy\xa0z w \x0c Q", "a"]
    words, count = hmm.split_words(pa.array(["skipped", *texts]).slice(1))
    assert words.to_pylist() == [w for t in texts for w in hmm.words_of(t)]
    assert count.tolist() == [len(hmm.words_of(t)) for t in texts]


def test_packed_numbers_and_shares_come_back():
    rng = np.random.default_rng(3)
    codes = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], dtype=np.uint32)
    assert (hmm.numbers(hmm.planes(codes)) == codes).all() and len(hmm.numbers(hmm.planes(codes[:0]))) == 0
    share = rng.dirichlet(np.ones(8), 50)
    got = hmm.shares(hmm.halves(share), 50, 8)
    assert np.allclose(got, share, atol=1e-3) and np.allclose(got.sum(1), 1, atol=1e-12)
    assert hmm.shares(hmm.halves(np.ones((3, 1))), 3, 1).tolist() == [[1.0]] * 3


def test_words_put_together_come_apart():
    import pyarrow as pa

    words = ["a", "bb", "été", "xyz", "\x1cq", "ab\x00c", "w" * 300]
    words = [w.encode() for w in words]
    found = hmm.together(pa.array(words, pa.binary()), np.array([2, 2, 6, 7]))
    assert found == [b"a bb", b"", b" ".join(words[2:6]), words[6]]
    again, sizes = hmm.apart([x for x in found if x])
    assert again.to_pylist() == words and sizes == [2, 4, 1]
    assert hmm.classes_of(again).tolist() == [hmm.word_class(w) for w in words]
    nothing, sizes = hmm.apart([])
    assert nothing.to_pylist() == [] and sizes == [] and len(hmm.classes_of(nothing)) == 0


def test_a_walk_keeps_the_numbers_of_a_step_once():
    """The expected counts held three copies of every token's states: 130 bytes a token of 8 states."""
    import tracemalloc

    rng = np.random.default_rng(6)
    model = hmm.initial(np.ones(50), 8, 1)
    runs = [rng.integers(0, 50, 256) for _ in range(400)]
    tracemalloc.start()
    try:
        hmm.expected_counts(model, runs, np.ones(400, dtype=bool))
        peak = tracemalloc.get_traced_memory()[1] / (400 * 256)
    finally:
        tracemalloc.stop()
    assert peak < 90


def test_sums_across_are_those_of_numpy():
    rng = np.random.default_rng(8)
    for states, kind in itertools.product((1, 2, 3, 8), (np.float32, float)):
        a = rng.random((500, states)).astype(kind)
        got = hmm.across(a)
        assert (got == a.sum(1)).all() and got.dtype == kind and not np.shares_memory(got, a)
    assert np.allclose(hmm.across(rng.random((4, 5)) * 0 + 1), 5) and len(hmm.across(np.zeros((0, 8)))) == 0


def block_table(texts, places=3):
    """A block's rows as its steps get them."""
    import pyarrow as pa

    batch = pa.record_batch({"doc_id": [str(k) for k in range(len(texts))], "held_out": [k % 5 == 0 for k in range(len(texts))], "text": texts})
    names = ["block", "part", "doc_ids", "held_out", "sizes", "codes", "place", "words", "counts"]
    kinds = [pa.int64(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.bool_()), pa.list_(pa.int32()), pa.binary(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array(x, k) for x, k in zip(zip(*hmm.block_rows(0, [batch], places)), kinds)], names=names)


def test_a_block_is_read_part_by_part(monkeypatch):
    """All texts of a block were held as symbols beside their packed numbers: 8 bytes a token and more."""
    import tracemalloc

    monkeypatch.setattr(hmm, "PART", 10_000)
    texts = [" ".join(f"w{(k + j * j) % 70}" for j in range(1000 + k)) if k else None for k in range(300)]
    rows = block_table(texts[::-1])
    tracemalloc.start()
    try:
        block = hmm.read_block(rows, [b"w3", b"w5"])
        tokens = sum(len(symbols) for *_, symbols in block.parts())
        peak = tracemalloc.get_traced_memory()[1] / tokens
    finally:
        tracemalloc.stop()
    assert peak < 2
    ids, held_out, sizes, symbols = (np.concatenate(x).tolist() for x in zip(*block.parts()))
    assert ids == [str(k) for k in range(300)] and held_out == [k % 5 == 0 for k in range(300)]
    assert sizes == [len(hmm.words_of(t)) + 1 for t in texts[::-1]]
    words = {s: w for w, s in zip([w for t in texts[::-1] for w in [*hmm.words_of(t), None]], symbols)}
    assert len(words) == 71 and words[0] == b"w3" and words[1] == b"w5" and words[2 + hmm.CLASSES] is None
    assert [words[s] for s in symbols] == [w for t in texts[::-1] for w in [*hmm.words_of(t), None]]
    runs = [(runs, first) for runs, first in hmm.learned_runs(block)]
    want = [w for k, t in enumerate(texts[::-1]) if k % 5 for w in [*hmm.words_of(t), None]]
    assert [words[s] for x, _ in runs for run in x for s in run] == want and sum(f.sum() for _, f in runs) == 240


def test_own_words_take_little_besides_their_emissions(monkeypatch):
    """The probabilities of all of a block's own words were worked out at once: over 400 bytes a word of 8 states."""
    import tracemalloc

    import pandas as pd

    rng = np.random.default_rng(9)
    monkeypatch.setattr(hmm, "WORDS", 1 << 12)
    model, each = hmm.initial(np.ones(3 + hmm.CLASSES + 1), 8, 1), [0, 5_000, 1, 60_000, 35_000, 0, 4_000]
    size = sum(each)
    classes, n, share = rng.integers(0, hmm.CLASSES, size), rng.integers(0, 9, size), rng.dirichlet(np.ones(8), size)
    ends = np.cumsum(each)
    by_state = {p: hmm.halves(share[end - k:end]) for p, (k, end) in enumerate(zip(each, ends))}
    block = hmm.Block([], np.zeros(1), classes, n, [(p, np.arange(k)) for p, k in enumerate(each)])
    total, distinct = np.bincount(classes, n, hmm.CLASSES), np.bincount(classes, minlength=hmm.CLASSES)
    of_state = rng.random((hmm.CLASSES, 8)) * total[:, None]
    for found in (by_state, {}):
        own = n[:, None] * np.concatenate([hmm.shares(by_state[p], k, 8) for p, k in enumerate(each)]) if found else np.zeros((size, 8))
        words, names = pd.DataFrame(own).add_prefix("h").assign(**{"class": classes, "n": n}), [f"h{k}" for k in range(8)]
        want = model.emit[3 + classes] * hmm.within_class(words, names, of_state, total, distinct)
        for kind in (float, np.float32):
            got = hmm.with_words(model, block, n, found, of_state, total, distinct, kind=kind).emit
            assert (got[:-size] == model.emit.astype(kind)).all() and (got[-size:] == want.astype(kind)).all()
    even = [2_080] * 50
    tracemalloc.start()
    try:
        hmm.with_words(model, hmm.Block([], np.zeros(1), classes[:104_000], n[:104_000], [(p, np.arange(k)) for p, k in enumerate(even)]), n[:104_000],
                       {p: hmm.halves(share[p * k:p * k + k]) for p, k in enumerate(even)}, of_state, total, distinct, kind=np.float32)
        peak = tracemalloc.get_traced_memory()[1] / size
    finally:
        tracemalloc.stop()
    assert peak < 120
