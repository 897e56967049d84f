from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from vidtrend.llm import warc
from vidtrend.llm.common import shared_path
from vidtrend.llm.queries import op4_warc

SCHEMA = "page_id long, url string, html string"


def expected(rows, least=100):
    groups = defaultdict(list)
    for page_id, html in rows:
        if len((html or "").encode()) >= least and page_id is not None:
            groups[html].append(page_id)
    out = []
    for page_id, html in rows:
        data = (html or "").encode()
        first = min(groups[html]) if html in groups and page_id is not None else page_id
        out.append((page_id, len(data), hashlib.sha256(data).hexdigest(), "response" if first == page_id else "revisit",
                    None if first == page_id else first))
    return sorted(out, key=str)


def record(page_id, payload, kind="response"):
    http = "HTTP/1.1 200 OK\r\nContent-Length: 5\r\n\r\n"
    return (f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:vidtrend:page:{page_id}>\r\n"
            f"Content-Length: {len((http + payload).encode())}\r\n\r\n{http}{payload}\r\n\r\n")


def nasty_pages():
    inner = record(777, "inner " * 30) + record(778, "x")
    pages = [(k, f"http://h/{k}", f"<p>page {k}</p>" * 20) for k in range(20)]
    pages += [(100 + k, None, "<p>the same page</p>" * 10) for k in range(12)]
    pages += [(200, "u\r\nWARC-Type: x", None), (201, "", ""), (202, "é", "é€😀" * 50), (203, "a", "short"), (204, "a", "short"),
              (None, "n", "<p>the same page</p>" * 10), (205, "dup", "twice" * 40), (205, "dup", "twice" * 40),
              (300, "m", inner), (301, "m", "before " + inner + inner), (302, "m", "WARC/1.1\r\n" * 40), (303, "m", inner),
              (304, "m", "WWARC/1.1\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc"), (305, "m", "\r\n\r\nWARC/1.1\r\nContent-Length: 99999999999\r\n\r\n"),
              (306, "m", "ends with the magic WARC/1.1\r\n"), (307, "m", "Content-Length: 7\r\n\r\n" * 9)]
    return pages


@pytest.mark.parametrize("split,compression", [("128m", "none"), ("700b", "none"), ("700b", "gzip")])
def test_round_trip_with_magic_inside_payloads(spark, split, compression):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    pages = nasty_pages()
    path = shared_path(spark, "warc-test")
    warc.write(spark.createDataFrame(pages, SCHEMA).withColumn("digest", F.lit("x")).repartition(2), path, file_records=15, compression=compression)
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        got = sorted((tuple(r) for r in warc.read(spark, path).select(
            "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == expected([(p, h) for p, _, h in pages])


def test_pointer_jumping_keeps_the_chain_from_the_start(spark):
    chain = [("a", 10 * k, 10 * (k + 1)) for k in range(37)] + [("b", 0, 50), ("b", 20, 30), ("b", 30, 50), ("b", 50, 90), ("c", 5, 9)]
    got = {tuple(r) for r in warc.reached(spark.createDataFrame(chain, "file string, off long, next long")).collect()}
    assert got == {("a", 10 * k) for k in range(37)} | {("b", 0), ("b", 50)}


def test_query_equals_brute_force(spark, tiny):
    rows = [(r.page_id, r.html) for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in op4_warc(spark, tiny).collect()]
    assert sorted(got, key=str) == expected(rows)


def test_empty_table(spark):
    path = shared_path(spark, "warc-test")
    warc.write(spark.createDataFrame([], SCHEMA), path)
    assert warc.read(spark, path).count() == 0
