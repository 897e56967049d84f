from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from vidtrend.llm import simhash


def plain_fingerprint(text, n=3):
    """The contract, bit by bit."""
    from xxhash import xxh64

    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in low + " ":
        if c in " \t\n\x0b\x0c\r":
            words, word = (words + [word] if word else words), ""
        else:
            word += c
    if not words:
        return 0
    parts = [" ".join(words[k:k + n]) for k in range(len(words) - n + 1)] or [" ".join(words)]
    hashes = [xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(prints, max_bits=2):
    """{fingerprint: fingerprints linked}, by all pairs."""
    prints = sorted(set(prints))
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for k, a in enumerate(prints):
        for b in prints[:k]:
            if (a ^ b).bit_count() <= max_bits:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {p: root(p) for p in prints}


def expected(rows):
    prints = [plain_fingerprint(r.text) for r in rows]
    of = brute_components(prints)
    least = {}
    for r, p in zip(rows, prints):
        if r.doc_id is not None:
            least[of[p]] = min(least.get(of[p], r.doc_id), r.doc_id)
    return sorted(((r.doc_id, f"{p:016x}", least.get(of[p])) for r, p in zip(rows, prints)), key=str)


def test_fingerprints_follow_the_contract():
    for text in (None, "", "  ", "a", "A b", "One two THREE four", "É é À x y z\x0bq", "a b c " * 40, "x" * 9000):
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_gray_rank_orders_the_gray_sequence():
    codes = np.array([k ^ (k >> 1) for k in range(300)], dtype=np.uint64)
    assert simhash.gray_rank(codes).tolist() == list(range(300))


def test_tree_finds_all_pairs_within_the_limit():
    rng = random.Random(2)
    seeds = [rng.getrandbits(64) for _ in range(40)]
    prints = list({s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(4))) for s in seeds for _ in range(25)})
    codes = np.array(prints, dtype=np.uint64)
    codes = codes[np.argsort(simhash.gray_rank(codes))]
    tree = simhash.GrayTree(codes, np.full(len(codes), ~np.uint64(0)))
    got = {(int(a), int(b)) for q, leaf in tree.search(codes, 2) for a, b in zip(q, leaf)}
    want = {(a, b) for a in range(len(codes)) for b in range(len(codes)) if int(codes[a] ^ codes[b]).bit_count() <= 2}
    assert got == want


def test_links_over_many_blocks_connect_what_pairs_connect(spark):
    rng = random.Random(5)
    prints = {0, (1 << 64) - 1}
    for _ in range(60):  # chains and clusters of near fingerprints
        p = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            prints.add(p)
            for _ in range(rng.randrange(1, 4)):
                p ^= 1 << rng.randrange(64)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.link_fingerprints(spark.createDataFrame(signed, "fp long"), 2, block_rows=5)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in links.collect():
        a, b = r.a % (1 << 64), r.b % (1 << 64)
        parent[max(root(a), root(b))] = min(root(a), root(b))
    assert {p: root(p) for p in prints} == brute_components(prints)


def test_components_of_edge_rows(edge):
    clash = edge.withColumn("fp", F.lit("x")).withColumn("component", F.lit(1)).withColumn("rank", F.lit(2))
    got = simhash.components(clash)
    assert sorted(((r.doc_id, r.fingerprint, r.component_id) for r in got.collect()), key=str) == expected(edge.collect())
    kept = simhash.one_of_each(clash)
    assert kept.columns == clash.columns
    assert kept.count() == len(set(brute_components([plain_fingerprint(r.text) for r in edge.collect()]).values()))


def test_query_equals_brute_force(spark, tiny):
    from vidtrend.llm.queries import op7_simhash

    rows = spark.read.parquet(f"{tiny}/documents.parquet").collect()
    assert sorted(map(tuple, op7_simhash(spark, tiny).collect()), key=str) == expected(rows)


def test_empty_table(empty):
    assert simhash.components(empty).count() == 0


def test_links_take_one_python_step_a_task(spark, capsys):
    distinct = spark.range(1000).select((F.col("id") * 7919).alias("fp"))
    simhash.link_fingerprints(distinct).explain()
    assert capsys.readouterr().out.count("MapInPandas") == 1  # each more would hold a worker of its own
