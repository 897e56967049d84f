from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vidtrend.llm import packing
from vidtrend.llm.queries import END_ID, packed, word_bpe
from vidtrend.llm.tokens import ChunkEncoder


def tokenizer():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(word_bpe())
    t.encode_special_tokens = True
    return t


def test_chunks_give_the_ids_of_the_whole_text():
    t, encoder, rng = tokenizer(), ChunkEncoder(word_bpe()), random.Random(4)
    alphabet = "aA É.,bΣ'sé́\t\n\r\x0b\x0c\x1c\x85 ​<|>endoftxt!12ßİſ½"
    texts = ["", None, "  ", "<|endoftext|> x", "don 't a' s", *("".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000))]
    for text, ids in zip(texts, encoder.encode(pa.array(texts), [7]).to_pylist()):
        assert np.frombuffer(ids, encoder.dtype).tolist() == [*t.encode(text or "", add_special_tokens=False).ids, 7], repr(text)


def test_sequence_ends_are_windows_then_powers_of_two():
    assert packing.sequence_ends(10, 4) == [4, 8, 10]
    assert packing.sequence_ends(7, 8) == [4, 6, 7]
    assert packing.sequence_ends(0, 8) == []


def test_round_robin_serves_all_and_keeps_the_mixture():
    turns = packing.serve([40_000, 20_000, 20_000], [0.5, 0.25, 0.25], [0.0, 0.0, 0.0], 4096, 512)
    served, at = [0, 0, 0], 0
    for s, n in turns:
        served[s] += n
        at += n
        if at < 70_000:  # while every queue holds tokens, each is within one turn of its share
            assert abs(served[0] - 0.5 * at) <= 4096
    assert served == [40_000, 20_000, 20_000]
    # a debt from earlier lanes is worked off first
    assert packing.serve([1000, 1000], [0.5, 0.5], [-3000.0, 0.0], 1024, 256)[0][0] == 1


def check_pieces(rows, texts, window=4096):
    """Every id of every document in exactly one piece; sequences without gaps."""
    t, by_doc, by_sequence = tokenizer(), defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc_id, pieces in by_doc.items():
        copies = texts[doc_id]
        want = [t.encode(x or "", add_special_tokens=False).ids + [END_ID] for x in copies]
        assert sum(p.length for p in pieces) == sum(map(len, want))
        for p in pieces:
            crcs = [zlib.crc32(np.array(w[p.start:p.start + p.length], "<u4").tobytes()) for w in want if len(w) == p.doc_tokens]
            assert p.ids_crc32 in crcs
        if len(copies) == 1:
            at = 0
            for p in sorted(pieces, key=lambda p: p.start):
                assert p.start == at
                at += p.length
    sizes = []
    for pieces in by_sequence.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= window and at & (at - 1) == 0
        sizes.append(at)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sizes


def test_edge_rows_are_packed_whole(edge):
    texts = defaultdict(list)
    for r in edge.collect():
        texts[r.doc_id].append(r.text)
    sizes = check_pieces(packed(edge.withColumn("lane", F.lit("x")).withColumn("ids", F.lit(0))).collect(), texts)
    assert sizes.count(4096) >= 5


def test_small_lanes_carry_deficits(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/documents.parquet")
    pieces = packing.pack(documents, word_bpe(), END_ID, window=1024, quantum=128, lane_tokens=8192)
    rows = pieces.withColumn("ids_crc32", F.crc32("ids")).collect()
    sizes = check_pieces(rows, {r.doc_id: [r.text] for r in documents.collect()}, 1024)
    assert sizes.count(1024) * 1024 >= 0.9 * sum(sizes)


def shares_of_windows(pieces, window):
    """Per full window in order, the share of each source."""
    tokens = defaultdict(lambda: defaultdict(int))
    for r in pieces:
        tokens[r.sequence_id][r.source] += r.length
    return [{s: n / window for s, n in tokens[q].items()} for q in sorted(tokens) if sum(tokens[q].values()) == window]


def test_targets_hold_in_every_window_of_many_lanes(spark):
    """Two sources with as many tokens each, wanted as 80 to 20: the mixture lasts as long as the first
    source does, at the targets in every lane, and what is over of the other comes last."""
    docs = spark.range(40_000).select(F.col("id").alias("doc_id"), F.lit("word word word word word").alias("text"),
                                      F.concat(F.lit("s"), (F.col("id") % 2).cast("string")).alias("source"))
    pieces = packing.pack(docs, word_bpe(), END_ID, window=256, quantum=32, lane_tokens=8192, targets={"s0": 0.8, "s1": 0.2}).collect()
    windows = shares_of_windows(pieces, 256)
    share = np.array([w.get("s0", 0.0) for w in windows])
    mixed = int(np.flatnonzero(share)[-1]) + 1
    # lanes of 32 windows are dealt by hash, so the last windows of one may lack a source
    assert len(windows) > 600 and 0.5 < mixed / len(windows) < 0.7
    assert abs(share[:mixed].mean() - 0.8) < 0.02 and (np.abs(share[:mixed] - 0.8) < 0.1).mean() > 0.9
    # all tokens are there
    whole = sum(r.length for r in packing.pack(docs, word_bpe(), END_ID, window=256, lane_tokens=8192).collect())
    assert sum(r.length for r in pieces) == whole and len({r.doc_id for r in pieces}) == 40_000


def test_targets_of_some_sources_and_odd_ones(spark):
    docs = spark.createDataFrame([(k, "word " * 20, f"s{k % 4}") for k in range(400)], "doc_id long, text string, source string")
    for targets in ({"s0": 0.1}, {"s0": 0.0, "s1": 1.0}, {"none": 0.5}, {"s0": 5.0, "s1": 1.0, "s2": 1.0, "s3": 1.0}):
        pieces = packing.pack(docs, word_bpe(), END_ID, window=128, quantum=16, lane_tokens=2048, targets=targets).collect()
        assert len({r.doc_id for r in pieces}) == 400
        assert all(sum(x.length for x in pieces if x.doc_id == k) == next(x.doc_tokens for x in pieces if x.doc_id == k) for k in range(0, 400, 37))


def test_sums_over_earlier_lanes(spark):
    rng = random.Random(2)
    rows = sorted({(rng.choice("ab"), rng.randrange(100)): rng.randrange(9) for _ in range(150)}.items())
    df = spark.createDataFrame([(s, lane, n) for (s, lane), n in rows], "source string, lane long, n long")
    for block in (1, 7, 4096):
        for keys in ([], ["source"]):
            got = {(r.source, r.lane): r.x for r in packing._earlier(df if keys else df.where("source = 'a'"), {"x": F.col("n")}, keys, block).collect()}
            assert got and all(x == sum(n for (s2, l2), n in rows if s2 == s and l2 < lane) for (s, lane), x in got.items())


def test_empty_table_and_bad_window(empty):
    assert packed(empty).count() == 0
    with pytest.raises(ValueError):
        packing.pack(empty, word_bpe(), window=1000)
