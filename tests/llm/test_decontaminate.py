from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from vidtrend.llm import decontaminate as D

SCHEMA = "item_id long, text string"


def brute(documents, items, threshold, shingle=5, overlap=0.8):
    """Every passage scored against every item, without index or pruning."""
    index = D.ItemIndex(items)
    weights = {}
    for (t, _), posting in index.postings.items():
        for k, x in posting:
            weights.setdefault(k, {})[t] = x
    out = set()
    for doc_id, text in documents:
        words = D.words_of(text)
        for s in range(0, len(words), index.longest):
            passage = words[s:s + 2 * index.longest]
            own = {index.term[w] for w in passage if w in index.term}
            for k, (item_id, item) in enumerate(index.items):
                if sum(x for t, x in weights[k].items() if t in own) < threshold - 1e-9:
                    continue
                ok = True
                for part in D.parts_of(item):
                    n = min(shingle, max(1, len(part)))
                    want = D.shingles(part, n)
                    ok &= not want or len(want & D.shingles(passage, n)) / len(want) >= overlap
                if ok:
                    out.add((doc_id, item_id))
    return out


@pytest.fixture(scope="module")
def case():
    rng = random.Random(8)
    common, rare = [f"c{k}" for k in range(30)], [f"r{k}" for k in range(900)]
    sentence = lambda n: " ".join(rng.choice(common if rng.random() < 0.5 else rare) for _ in range(n))
    items = [(k, f"{sentence(rng.randrange(6, 30))}.\n{sentence(rng.randrange(2, 9))}") for k in range(40)]
    items += [(90, sentence(12) + "? " + sentence(6) + "."), (91, "one two"), (92, ""), (93, items[0][1])]
    documents = []
    for k in range(60):
        text = sentence(rng.randrange(0, 400))
        if k % 3 == 0:  # whole, in upper case, or with one word of many changed
            item = items[rng.randrange(len(items) - 3)][1]
            item = item.upper() if k % 2 else item.replace("c1 ", "zz ", 1)
            text = text[:200] + " " + item + " " + text[200:]
        if k % 3 == 1:  # the question without its answer
            text += " " + items[rng.randrange(40)][1].split("\n")[0]
        documents.append((k, text))
    return documents, items


def test_search_equals_scoring_everything(case):
    documents, items = case
    index = D.ItemIndex(items)
    for threshold in (0.2, 0.5, 0.9):
        for _, text in documents[:20]:
            terms = sorted({index.term[w] for w in D.words_of(text) if w in index.term})
            want = {}
            for (t, _), posting in index.postings.items():
                if t in terms:
                    for k, x in posting:
                        want[k] = want.get(k, 0) + x
            got = dict(index.search(terms, list(range(index.blocks)), threshold))
            sure = {k for k, x in want.items() if abs(x - threshold) > 1e-6}
            assert {k for k in got if k in sure} == {k for k in sure if want[k] >= threshold}


def test_matches_equal_brute_force(spark, case):
    documents, items = case
    docs = spark.createDataFrame(documents, "doc_id long, text string").withColumn("score", F.lit("x"))
    rows = D.matches(docs, spark.createDataFrame(items, SCHEMA)).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    assert got == brute(documents, [i for i in items if i[1]], 0.5) and len(got) == len(rows) >= 10
    shards = D.matches(docs, spark.createDataFrame(items, SCHEMA), shard_items=9).collect()
    assert {(r.doc_id, r.item_id) for r in shards} >= {(d, i) for d, i in got if i < 90 and i}
    kept = D.clean(docs, spark.createDataFrame(items, SCHEMA))
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in documents} - {d for d, _ in got}


def test_results_do_not_depend_on_shards_or_slices(spark, case, monkeypatch):
    documents, items = case
    docs, own = spark.createDataFrame(documents, "doc_id long, text string"), spark.createDataFrame(items, SCHEMA)

    def rows(shard_items):
        return sorted((r.doc_id, r.item_id, round(r.score, 9), r.passage_start, r.question_overlap, r.answer_overlap)
                      for r in D.matches(docs, own, threshold=0.3, shard_items=shard_items).collect())

    want = rows(4096)
    assert want and rows(9) == want and rows(3) == want
    index = D.ItemIndex([i for i in items if i[1]])
    whole = D.find(index, [t for _, t in documents], 0.3, 5, 0.8)
    for cells in (1, 40, 1000):
        monkeypatch.setattr(D, "CELLS", cells)
        assert D.find(index, [t for _, t in documents], 0.3, 5, 0.8) == whole != {}


def test_planted_items_are_found_and_others_left(spark, tiny):
    documents, items = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r.item_id: " ".join(D.words_of(r.text)) for r in items.collect()}
    want = {(r.doc_id, i) for r in documents.collect() for i, t in texts.items() if t in " ".join(D.words_of(r.text))}
    got = {(r.doc_id, r.item_id) for r in D.matches(documents, items).collect()}
    assert want and got == want


def test_edges_and_empty_tables(spark, edge, empty):
    items = spark.createDataFrame([(1, None), (None, "dup"), (2, ""), (3, "Same Text here, twice over")], SCHEMA)
    assert {r.doc_id for r in D.matches(edge, items).collect()} == {100 + k for k in range(9)}
    assert D.clean(edge, items).count() == edge.count() - 9
    assert D.matches(empty, items).count() == 0 and D.clean(edge, items.limit(0)).count() == edge.count()
    nobody = D.matches(edge, spark.createDataFrame([(4, "no id")], SCHEMA)).collect()
    assert [(r.doc_id, r.item_id) for r in nobody] == [(None, 4)]
