from __future__ import annotations

import random


from vidtrend.llm import common
from vidtrend.llm.common import fresh, min_labels, shared_dir


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(0, 200)] + [(1000, 1000 + k) for k in range(1, 80)] + [(3000, 3001), (3001, 3002), (3002, 3000)]
    edges += [(rng.randrange(4000, 4100), rng.randrange(4000, 4100)) for _ in range(60)]
    parent = {n: n for e in edges for n in e}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    rng.shuffle(edges)
    got = {r.node: r.root for r in min_labels(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: root(n) for n in parent if n in got} and all(root(n) == n for n in set(parent) - set(got))


def test_fresh_names_ignore_case():
    assert fresh("rank", ["RANK", "_rank"]) == "__rank"


def test_shared_folder_is_the_named_one(spark):
    old = spark.conf.get("spark.checkpoint.dir", None)
    if old:
        assert shared_dir(spark) == old.rstrip("/")
    else:
        assert shared_dir(spark).startswith("file:///") and shared_dir(spark) == shared_dir(spark)


def test_entry_lists_all_operators_and_the_pipeline():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)}
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


def test_least_hashed_rows(spark):
    from pyspark.sql import functions as F
    df = spark.range(400).withColumn("h", F.xxhash64(F.col("id") % 50))
    rows = sorted((r.h, r.id) for r in df.collect())
    for n in (0, 1, 7, 60, 399, 500):
        assert [(r.h, r.id) for r in common.least_hashed(df, F.col("h"), n, ["id"]).collect()] == rows[:n]
    same = spark.range(30).withColumn("h", F.lit(2**63 - 1))   # none is below a threshold
    assert [r.id for r in common.least_hashed(same, F.col("h"), 3, ["id"]).collect()] == [0, 1, 2]


def test_links_that_do_not_settle_are_an_error(spark):
    import pytest
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)], "a long, b long")
    with pytest.raises(RuntimeError, match="still change"):
        common.min_labels(edges, max_rounds=1)
    assert {r.root for r in common.min_labels(edges).collect()} == {0}
