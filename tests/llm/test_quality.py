from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vidtrend.llm import quality, queries

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("slice_tokens", [quality.SLICE_TOKENS, 1, 7])
def test_mean_vectors_equal_the_features_one_by_one(monkeypatch, slice_tokens):
    monkeypatch.setattr(quality, "SLICE_TOKENS", slice_tokens)
    rng = np.random.default_rng(1)
    vectors = rng.standard_normal((512, 8)).astype(np.float32)
    texts = ["a b a", "", None, "one", "Éa Éa Éa", "x" * 5000, " ".join(map(str, range(3000)))]
    got = quality.mean_vectors(texts, vectors)
    for text, row in zip(texts, got):
        ids, share = quality.features(text, 512)
        assert np.allclose(share @ vectors[ids] if len(ids) else np.zeros(8), row, atol=1e-4)


def test_held_out_accuracy(spark):
    rows = {r.doc_id: r for r in queries.op5_quality(spark, SF).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= r.score <= 1 for i, r in rows.items())
    assert all(r.predicted == int(r.score >= 0.7) for r in rows.values())
    held = [i for i in labels if rows[i].held_out]
    assert np.mean([rows[i].predicted == labels[i] for i in held]) >= 0.93


def test_only_usable_labels_are_read(spark):
    documents, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = queries.quality_model(documents, labels)
    turned = labels.withColumn("quality", F.expr("CASE WHEN crc32(CAST(doc_id AS STRING)) % 4 = 2 THEN 1 - quality ELSE quality END"))
    again = queries.quality_model(documents.repartition(5), turned)
    assert np.allclose(model.vectors, again.vectors) and np.allclose(model.bias, again.bias)


def test_edges_and_empty_tables(spark, edge, empty):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(12)] + [(None, 1, 0), (13, None, 1)], "doc_id long, quality int, toxic int")
    documents = edge.withColumn("score", F.lit("x")).withColumn("label", F.lit(1))
    model = quality.fit(documents, labels, lambda c: F.lit(True), epochs=1)
    assert quality.score(documents, model).count() == edge.count()
    for docs, known in ((empty, labels), (edge, labels.limit(0)), (edge, labels.where("quality = 1"))):
        model = quality.fit(docs, known, lambda c: F.lit(True), epochs=1)
        scores = {round(r.score, 6) for r in quality.score(edge, model).collect()}
        assert len(scores) >= 1 and all(0 <= s <= 1 for s in scores)


def test_the_sample_is_learned_from_in_a_task_not_in_the_driver(spark, edge, monkeypatch, tmp_path):
    import os

    learned, plain = tmp_path / "learned", quality.train

    def noted(rows, *rest):
        learned.write_text(f"{os.getpid()} {len(rows)}")
        return plain(rows, *rest)

    monkeypatch.setattr(quality, "train", noted)
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, quality int")
    model = quality.fit(edge, labels, lambda c: F.lit(True), epochs=1)
    pid, rows = map(int, learned.read_text().split())
    assert pid != os.getpid() and rows == 12
    texts = {r.doc_id: r.text for r in edge.where("doc_id < 12").collect()}
    own = [(*quality.features(texts[k], 1 << 16), k % 2) for k in range(12)]
    here = plain(own, 1 << 16, 16, 1, 0.5, 7)
    assert np.allclose(model.vectors, here.vectors, atol=1e-6) and np.allclose(model.layer, here.layer, atol=1e-6)
    assert np.allclose(model.bias, here.bias, atol=1e-6)  # both labels are as frequent as in the sample
