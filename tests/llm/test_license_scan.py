from __future__ import annotations

import textwrap

import pytest
from pyspark.sql import functions as F

from vidtrend.llm import license_scan
from vidtrend.llm.license_scan import TEMPLATES

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def model(spark):
    return license_scan.fit(spark.read.parquet(f"{SF}/documents.parquet"))


def test_templates_are_told_apart_and_confirmed(spark, model):
    rows = [(k, f"Some words before.\n{t}\nand after") for k, t in enumerate(t for own in TEMPLATES.values() for t in own)]
    want = [f for f, own in TEMPLATES.items() for _ in own]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert set(got) == set(range(len(rows))) and all(r.paragraph == 1 and r.confirmed for r in got.values())
    assert [got[k].family for k in range(len(rows))] == want


def test_wrapped_and_stemless_statements(spark, model):
    grant = TEMPLATES["MIT"][2]
    rows = [(0, "confidential. Unauthorized copying of this file is strictly prohibited."),
            (1, "documentation files, to deal in the Software without restriction, including without limitation the rights"),
            *((k, "First.\n\n" + "\n".join(textwrap.wrap(grant, k)) + "\n\nLast.") for k in (72, 80))]
    got = {}
    for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA), model).collect():
        got.setdefault(r.doc_id, set()).add((r.family, r.confirmed))
    assert got[0] == {("Proprietary", True)} and got[1] == {("MIT", True)} and ("MIT", True) in got[72] & got[80]


def test_wrapped_lines_are_joined(spark):
    a, b = "a" * 60 + " one", "b" * 55 + " two"
    df = spark.createDataFrame([(1, f"x\n{a}\n{b}\nend.\n{a}\n\n{b}"), (2, a), (3, ""), (4, None)], SCHEMA)
    got = [(r.doc_id, r.first, r.last, r.text) for r in license_scan.paragraphs(df).collect()]
    assert [g for g in got if g[1] < g[2]] == [(1, 1, 3, f"{a} {b} end.")] and len(got) == 10


def test_other_text_is_unknown(spark, model):
    rows = [(0, "The driver lost the licence plate in the permitted area"), (1, "copyright is a word"), (2, "Warranty void"),
            (3, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation")]
    got = {r.doc_id: r for r in license_scan.scan(spark.createDataFrame(rows, SCHEMA), model).collect()}
    assert got[3].family == "MIT" and got[3].confirmed
    assert not any(r.confirmed for k, r in got.items() if k < 3)


def test_every_licence_line_of_the_corpus(spark, model):
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    lines = {"This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
             "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0"}
    want = sorted((r.doc_id, k, lines[x]) for r in documents.collect() for k, x in enumerate((r.text or "").split("\n")) if x in lines)
    got = sorted((r.doc_id, r.paragraph, r.family) for r in license_scan.scan(documents, model).where("confirmed").collect())
    assert want and got == want


def test_the_bound_loses_no_paragraph(spark, model):
    """Every paragraph scored without it gives the same rows."""
    documents = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lambda **how: sorted(tuple(r) for r in license_scan.scan(documents, model, **how).collect())
    want = rows(bounded=False)
    got = rows()
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in want] != []
    assert all(abs(a[3] - b[3]) < 1e-9 for a, b in zip(got, want))


def test_known_ngrams_are_the_features_with_a_weight(spark, model):
    grams = {r.gram for r in model[0].collect()}
    bound = license_scan.Bound(model)
    lines = [t for own in TEMPLATES.values() for t in own] + ["", "the the the", "Licensed", "software is provided under the terms of the software"]
    df = spark.createDataFrame([(x,) for x in lines], "text string").select(license_scan.words(F.col("text")).alias("t"))
    for r in df.where(F.size("t") > 0).select(license_scan.features(F.col("t")).alias("every"), bound.known(F.col("t")).alias("known")).collect():
        assert len(r.known) == len(set(r.known)) and set(r.known) == grams & set(r.every)


def test_edges_and_empty_tables(spark, edge, empty, model):
    assert license_scan.scan(edge.withColumn("row", F.lit("x")).withColumn("gram", F.lit(1)), model).count() == 0
    assert license_scan.scan(empty, model).count() == 0
    same = spark.createDataFrame([(None, "Released under the MIT License.")] * 3, SCHEMA)
    bare = license_scan.fit(empty, sample_docs=5)
    for m in (model, bare):
        assert [(r.doc_id, r.family) for r in license_scan.scan(same, m).collect()] == [(None, "MIT")] * 3
