from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import prose
from vidtrend.llm import passages

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string"


def brute(rows, length=20):
    """Kept texts and counts of (doc_id, text) rows; equal rows are one document."""
    docs = sorted({(i is not None, i or 0, (t or "").encode()) for i, t in rows})
    seen, results = set(), {}
    for known, doc_id, text in docs:
        words = WORD.findall(text.decode())
        gone = set()
        for s in range(len(words) - length + 1):
            window = tuple(words[s:s + length])
            if window in seen:
                gone.update(range(s, s + length))
            seen.add(window)
        results[doc_id if known else None, text] = (" ".join(w for k, w in enumerate(words) if k not in gone), len(words), len(gone))
    return sorted(((i, *results[i, (t or "").encode()]) for i, t in rows), key=str)


def result(df):
    return sorted(((r.doc_id, r.text, r.n_words, r.n_removed) for r in df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def test_edge_rows(edge):
    rows = [(r.doc_id, r.text) for r in edge.collect()]
    assert result(passages.remove_repeats(edge)) == brute(rows)
    assert result(passages.remove_repeats(edge, length=3, shard_bytes=3000, patterns=7)) == brute(rows, 3)


@pytest.mark.parametrize("length", [1, 2, 5, 8, 20, 33])
def test_random_texts_of_few_words(spark, length):
    rng = random.Random(length)
    rows = [(k, " ".join(rng.choices("ab", [9, 1], k=rng.randrange(0, 3 * length + 20)))) for k in range(25)]
    rows += [(100 + k, rows[k][1] + " tail " + rows[k + 1][1]) for k in range(8)] + [(None, rows[2][1])]
    assert result(passages.remove_repeats(frame(spark, rows), length=length, shard_bytes=200, patterns=5)) == brute(rows, length)


def test_hot_passage_copies_and_one_word_texts(spark):
    passage = prose(900, 24)
    rows = [(k, f"{prose(k, 15)} {k} {passage}\t{k} {prose(k + 300, 9)}") for k in range(60)]
    rows += [(100 + k, prose(7, 80)) for k in range(30)] + [(200, "same " * 5000), (201, "same " * 300), (202, "same")]
    got = passages.remove_repeats(frame(spark, rows), shard_bytes=2000, patterns=50)
    assert result(got) == brute(rows)
    kept = {r.doc_id: r.n_removed for r in got.collect()}
    assert [k for k in range(60) if kept[k] < 24] == [0] and kept[100] == 0 and kept[101] == 80 and kept[200] == 4999 and kept[201] == 300


def test_whole_table_does_not_depend_on_the_shards(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in documents.collect()]
    assert result(passages.remove_repeats(documents, shard_bytes=20_000, patterns=100)) == brute(rows)


def test_other_columns_stay_and_clashing_ones_are_replaced(spark, edge, empty):
    odd = edge.withColumns({"shard": F.lit("s"), "n_words": F.lit("x"), "h": F.lit(1), "first": F.lit(2)})
    got = passages.remove_repeats(odd)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "h", "first", "n_words", "n_removed"]
    assert result(got) == result(passages.remove_repeats(edge)) and got.where("shard = 's' AND h = 1 AND first = 2").count() == got.count()
    assert passages.remove_repeats(empty).count() == 0


def test_hashes_of_runs_and_words():
    texts = [b"a bb ccc a bb ccc a", b"x" * (passages.SLICE + 9) + b" a bb", b"", b"\t a\x0b"]
    shard = passages.Shard(pa.table({"doc_id": [1, 2, 3, 4], "text": pa.array(texts, pa.binary())}))
    words = [w for text in shard.texts for w in text.split()]
    assert words == [shard.buffer[i:j].tobytes() for i, j in zip(shard.low, shard.high)] and shard.sizes.tolist() == [7, 3, 0, 1]
    hashes = shard.hashes()
    assert all((hashes[i] == hashes[j]) == (words[i] == words[j]) for i in range(11) for j in range(11))
    some = np.arange(60, dtype=np.uint64) % np.uint64(7)
    for length in (1, 2, 3, 7, 20):
        runs = passages._runs_hash(some, length, passages.WORD_BASES[0])
        want = [tuple(some[k:k + length]) for k in range(60 - length + 1)]
        assert len(runs) == len(want) and len(set(runs.tolist())) == len(set(want))


def test_automata_find_every_place_in_one_document_at_a_time(monkeypatch):
    rng = random.Random(3)
    words = [rng.choice([b"a", b"b", b"cc", b"d%d" % rng.randrange(900)]) for _ in range(4000)]
    doc = np.sort(np.array([rng.randrange(30) for _ in words]))
    phrases = list({b" ".join(words[i:i + n]): (i, i + n) for i in range(0, 3900, 3) for n in (2, 3, 5) if doc[i] == doc[i + n - 1]}.values())
    want = sorted((p, p + j - i - 1) for i, j in phrases for p in range(len(words) - (j - i) + 1)
                  if words[p:p + j - i] == words[i:j] and doc[p] == doc[p + j - i - 1])
    for base, patterns in ((80, 16_000), (80, 100), (9, 16_000)):
        monkeypatch.setattr(passages, "BASE", base)
        got = [np.stack(x, axis=1) for x in passages.located(words, doc, phrases, patterns)]
        assert sorted(map(tuple, np.concatenate(got).tolist())) == want and (len(got) > 1) == (patterns == 100 or base == 9)


def test_pairs_with_equal_first_hashes_are_told_apart():
    told = pa.table({"h1": pa.array([5, 5, 5, 9, 1]), "h2": pa.array([3, 1, 2, 0, 0], pa.int32())})
    h1, h2 = np.array([5, 5, 5, 5, 9, 9, 1, 7, 99], np.uint64), np.array([1, 2, 3, 4, 0, 1, 0, 0, 0], np.uint32)
    assert passages._found(told, h1, h2).tolist() == [1, 2, 0, -1, 3, -1, 4, -1, -1]
