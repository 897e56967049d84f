from __future__ import annotations

import hashlib
import string
from collections import defaultdict

from pyspark.sql import functions as F

from vidtrend.llm import linededup, queries

SF = "/root/testdata/sf0.01"
FOLD = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def key(line: str) -> str:
    return line.strip(" \t\n\x0b\x0c\r").translate(FOLD)


def brute(rows, min_docs=10, min_chars=1):
    docs = defaultdict(set)
    for r in rows:
        for line in (r.text or "").split("\n"):
            docs[key(line)].add(r.doc_id)
    gone = {k for k, ids in docs.items() if len(ids) >= min_docs and len(k) >= min_chars}
    out = []
    for r in rows:
        lines = (r.text or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((r.doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, hashlib.sha256(r.text.encode()).hexdigest()) for r in df.collect()), key=str)


def test_edge_rows(edge):
    rows = edge.collect()
    assert digest(linededup.drop_frequent_lines(edge)) == brute(rows)
    clash = edge.withColumn("t1", F.lit(1)).withColumn("n_lines", F.lit("x")).withColumn("drop", F.lit(2)).withColumn("h1", F.lit(3))
    got = linededup.drop_frequent_lines(clash, min_docs=3, batches=5, fanout=2)
    assert digest(got) == brute(rows, 3) and {"t1", "drop", "h1", "lang"} <= set(got.columns)
    assert digest(linededup.drop_frequent_lines(edge, min_docs=1, min_chars=4, batches=1)) == brute(rows, 1, 4)


def test_runs_are_compacted_and_counts_add_up(spark):
    runs = linededup.LineRuns(spark, min_docs=4, fanout=2, buckets=2)
    for n in range(7):
        runs.add(spark.createDataFrame([(1, 1, 1), (2, 2, 4 if n == 3 else 0), (3, n, 3)], "h1 long, h2 long, n long"))
    assert len(runs.levels) == 3  # seven batches, two runs a level
    assert sorted(tuple(r) for r in runs.finish().collect()) == [(1, 1), (2, 2)]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("line_run")]


def test_query_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = sorted(((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in queries.op10_line_dedup(spark, SF).collect()), key=str)
    assert got == brute(rows)


def test_marks(spark):
    df = spark.createDataFrame([([0],), ([3],), ([0, 1, 5],), ([],)], "p array<int>")
    assert [r.m for r in df.select(linededup.marks(F.col("p")).alias("m")).collect()] == [
        [True], [False] * 3 + [True], [True, True, False, False, False, True], []]


def test_work_grows_with_the_lines_of_a_document(spark):
    """Twenty times the lines, half of them dropped, take about as many times as long."""
    import time

    def seconds(n):
        text = "\n".join(f"own {k}" if k % 2 else f"shared {k % 40}" for k in range(n))
        docs = spark.createDataFrame([(k, text if not k else "\n".join(f"shared {j}" for j in range(40))) for k in range(10)], "doc_id long, text string")
        best = 1e9
        for _ in range(2):
            start = time.perf_counter()
            got = linededup.drop_frequent_lines(docs, batches=1).where("doc_id = 0").select("n_dropped", F.length("text").alias("n")).first()
            best = min(best, time.perf_counter() - start)
            assert got.n_dropped == n // 2 and got.n == len("\n".join(f"own {k}" for k in range(1, n, 2)))
        return best

    small, large = seconds(10_000), seconds(200_000)
    assert large < 20 * small + 5


def test_empty_table(empty):
    assert linededup.drop_frequent_lines(empty).count() == 0
