from __future__ import annotations

import corpus_pipeline as C
import pytest
from pyspark.sql import functions as F

from vidtrend.llm import decontaminate, queries
from vidtrend.llm.common import keep

from .test_linededup import brute, key
from .test_packing import check_pieces
from .test_simhash import brute_components, plain_fingerprint

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    out = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, f in C.STAGES:
        out.append(keep(f(spark, out[-1], SF), name.replace(" ", "-")))
    return out


def test_each_stage_equals_brute_force(spark, stages):
    raw, good, lines, single, clean, pieces = [s.collect() for s in stages]
    assert all(s.columns == C.DOCUMENTS for s in stages[:5])
    told = {r.doc_id: r.predicted for r in queries.op5_quality(spark, SF).collect()}
    assert {r.doc_id for r in good} == {i for i, p in told.items() if p == 1} and len(good) < len(raw)
    want = {i: (n, gone, sha) for i, n, gone, sha in brute(good)}
    import hashlib
    assert {r.doc_id: hashlib.sha256(r.text.encode()).hexdigest() for r in lines} == {i: w[2] for i, w in want.items()}
    assert all(r.n_chars == len(r.text) for r in lines) and key(" A ") == "a"
    prints = {r.doc_id: plain_fingerprint(r.text) for r in lines}
    of, least = brute_components(list(prints.values())), {}
    for i, p in prints.items():
        least[of[p]] = min(least.get(of[p], i), i)
    assert {r.doc_id for r in single} == set(least.values())
    items = spark.read.parquet(f"{SF}/benchmark.parquet")
    bad = {r.doc_id for r in decontaminate.matches(stages[3], items).collect()}
    assert bad and {r.doc_id for r in clean} == {r.doc_id for r in single} - bad
    check_pieces(pieces, {r.doc_id: [r.text] for r in clean})


def test_run_gives_the_same_pieces(spark, stages):
    columns = ["doc_id", "start", "length", "ids_crc32", "sequence_id", "offset"]
    got = C.run(spark, SF).select(*columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages[-1].select(*columns).collect()))


def test_edge_rows_pass_every_stage(spark, edge):
    docs = edge.withColumn("extra", F.lit(1))
    for name, f in C.STAGES:
        docs = keep(f(spark, docs, SF), "edge")
    assert docs.count() > 0
    empty = edge.limit(0)
    for name, f in C.STAGES:
        empty = keep(f(spark, empty, SF), "edge")
    assert empty.count() == 0
