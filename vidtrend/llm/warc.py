"""WARC archives of pages, and reading them back by boundary-chain verification.

Writing: one record per page through Spark's text writer, whose line separator is
the record terminator.  Of records with equal payloads of at least
``min_payload`` bytes the one with the smallest id is the response, the others are
revisits without payload that refer to it.

Reading: files are split at the record magic wherever it stands, also inside
payloads.  Every piece is a candidate record, and its header names the offset of
its successor.  Pointer jumping from the start of each file (every round doubles
the distance that a pointer spans) keeps the records that the chain of successors
reaches; magic inside payloads is not reached.  Files in which every candidate is
reached need no more.  The others are read once more, and the pieces between one
reached record and the next are joined again.

Defined results: a null html is the empty payload; a page with a null id is a
response and no revisit refers to it; rows equal in id and payload are responses
alike if theirs is the smallest id; an empty table gives no records.  Extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vidtrend.llm.common import keep

VERSION = "WARC/1.1\r\n"
END = "\r\n\r\n"
ID = "urn:vidtrend:page:"


def plan_revisits(pages: DataFrame, min_payload: int = 100) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat another page's payload."""
    payload = F.coalesce("html", F.lit(""))
    slim = (pages.where(F.octet_length(payload) >= min_payload).where("page_id is not null")
            .select("page_id", F.sha2(payload, 256).alias("digest")))
    first = (slim.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
             .where("last > refers_to").drop("last"))
    return slim.join(first, "digest").where("page_id > refers_to").select("page_id", "digest", "refers_to").distinct()


def write(pages: DataFrame, path: str, min_payload: int = 100, file_records: int = 8192,
          compression: str = "gzip", date: str = "1970-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as WARC files under ``path``, at most
    ``file_records`` records each; ``date`` is the WARC-Date of all records.

    ``compression``: ``"gzip"`` compresses each file, which one task then reads;
    ``"none"`` leaves files that are read in splits.  Offsets are those of the text."""
    payload = F.coalesce("html", F.lit(""))
    own = pages.select("page_id", "url", payload.alias("payload"), F.sha2(payload, 256).alias("digest"))
    seen = plan_revisits(pages, min_payload)
    all_pages = own.join(seen, ["page_id", "digest"], "left")
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    again = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"),
                    line("Content-Length", F.octet_length("payload").cast("string")), F.lit("\r\n"))
    block = F.when(again, F.col("http")).otherwise(F.concat("http", "payload"))
    uri = F.regexp_replace(F.col("url"), r"[\r\n]+", "%0D%0A")
    record = F.concat(
        F.lit(VERSION),
        line("WARC-Type", F.when(again, "revisit").otherwise("response")),
        line("WARC-Record-ID", F.concat(F.lit(f"<{ID}"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(date)),
        F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
        F.when(again, F.concat(line("WARC-Refers-To", F.concat(F.lit(f"<{ID}"), F.col("refers_to").cast("string"), F.lit(">"))),
                               line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))))
        .otherwise(""),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        line("Content-Type", F.lit("application/http;msgtype=response")),
        line("Content-Length", F.octet_length("block").cast("string")),
        F.lit("\r\n"), F.col("block"))
    (all_pages.withColumn("http", http).withColumn("block", block).select(record.alias("value"))
     .write.option("lineSep", END).option("maxRecordsPerFile", file_records).option("compression", compression).text(path))


def _header(head: Column, name: str, value: str) -> Column:
    found = F.regexp_extract(head, rf"(?i)(?:^|\r\n){name}:[ \t]*{value}", 1)
    return F.when(found != "", found)


def _parsed(value: Column) -> dict[str, Column]:
    """What a piece of a file (without its magic) says as a record."""
    parts = F.split(value, END, 3)
    head, http = F.get(parts, 0), F.get(parts, 1)
    start = F.octet_length(head) + len(END)
    content = F.when(F.size(parts) > 1, _header(head, "Content-Length", r"(\d{1,18})").cast("long"))
    body = start + F.octet_length(http) + len(END)
    payload = F.substring(value.cast("binary"), (body + 1).cast("int"),
                          F.greatest(F.lit(0), F.least(start + content - body, F.lit((1 << 31) - 1))).cast("int"))
    kind = F.lower(_header(head, "WARC-Type", r"(\w+)"))
    stored = _header(head, "WARC-Payload-Digest", r"sha256:([0-9a-f]{64})")
    return {
        "span": start + content + len(END),
        "whole": F.coalesce(F.octet_length(value) >= start + content, F.lit(False)),
        "page_id": _header(head, "WARC-Record-ID", rf"<{ID}(-?\d+)>").cast("long"),
        "record_type": kind,
        "refers_to": _header(head, "WARC-Refers-To", rf"<{ID}(-?\d+)>").cast("long"),
        "payload_bytes": F.when(kind == "revisit", _header(http, "Content-Length", r"(\d+)").cast("long"))
        .otherwise(F.length(payload).cast("long")),
        "payload_digest": F.when(kind == "revisit", stored).otherwise(F.sha2(payload, 256)),
    }


def _pieces(spark: SparkSession, paths: list[str], with_value: bool) -> DataFrame:
    """The files cut at every magic: (file, off, size, what the piece says); ``off`` is
    the offset of the piece's magic, from the sizes of all pieces before it."""
    raw = (spark.read.option("lineSep", VERSION).text(paths)
           .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("seq")))
    said = {k: c for k, c in _parsed(F.col("value")).items()}
    cut = raw.select("file", "block", "seq", (F.octet_length("value") + len(VERSION)).cast("long").alias("size"),
                     *[c.alias(k) for k, c in said.items()], *([F.col("value")] if with_value else []))
    cut = keep(cut, "pieces")
    # a split's pieces are in order; whole splits before it are summed apart, so no file meets in one task
    sizes = cut.groupBy("file", "block").agg(F.sum("size").alias("all"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = sizes.select("file", "block", F.coalesce(F.sum("all").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("file", "block").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    # the piece before the first magic stands for no record; its magic would lie before the file
    return (cut.withColumn("in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(base, ["file", "block"])
            .withColumn("off", F.col("base") + F.col("in") - len(VERSION)).drop("block", "seq", "base", "in"))


def reached(candidates: DataFrame) -> DataFrame:
    """(file, off) of the candidates (file, off, next) that the chain from offset 0 of
    their file reaches.  Every round follows all pointers and doubles them."""
    jump = keep(candidates.select("file", "off", F.col("next").alias("to")), "jump")
    there = keep(jump.where("off = 0").select("file", "off"), "reached")
    count = there.count()
    while count:
        landed = jump.join(there, ["file", "off"]).select("file", F.col("to").alias("off"))
        real = landed.join(candidates.select("file", "off"), ["file", "off"], "left_semi")
        there = keep(there.unionByName(real).distinct(), "reached")
        further = jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.off")))
        jump = keep(further.select("a.file", "a.off", "b.to"), "jump")
        now = there.count()
        if now == count:
            break
        count = now
    return there


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the archives under ``path``: (page_id, payload_bytes, payload_digest,
    record_type, refers_to).  A response's figures are those of the payload read."""
    out = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    pieces = keep(_pieces(spark, [path], False), "offsets")
    chain = _chain(pieces)
    state = pieces.where("off >= 0").join(chain.withColumn("ok", F.lit(True)), ["file", "off"], "left")
    odd = state.groupBy("file").agg(F.bool_and(F.coalesce("ok", F.lit(False)) & F.col("whole")).alias("plain")).where("not plain")
    odd = keep(odd.select("file"), "odd")
    plain = state.join(odd, "file", "left_anti").select(*out)
    names = [r.file for r in odd.collect()]  # files, not records
    return plain.unionByName(_rejoined(spark, names).select(*out)) if names else plain


def _chain(pieces: DataFrame) -> DataFrame:
    candidates = pieces.where("off >= 0 and span is not null")
    return reached(keep(candidates.select("file", "off", (F.col("off") + len(VERSION) + F.col("span")).alias("next")), "chain"))


def _rejoined(spark: SparkSession, names: list[str]) -> DataFrame:
    """The records of files that hold magic inside payloads: pieces up to the next reached
    record are one record.  A group is one record's pieces."""
    pieces = keep(_pieces(spark, names, True).where("off >= 0"), "values")
    state = pieces.join(_chain(pieces).withColumn("start", F.col("off")), ["file", "off"], "left")
    upto = Window.partitionBy("file").orderBy("off").rowsBetween(Window.unboundedPreceding, 0)
    owned = state.select("file", "off", "value", F.last("start", ignorenulls=True).over(upto).alias("start")).where("start is not null")
    joined = owned.groupBy("file", "start").agg(F.array_sort(F.collect_list(F.struct("off", "value"))).alias("parts"))
    whole = joined.select(F.array_join(F.transform("parts", lambda p: p["value"]), VERSION).alias("value"))
    return whole.select(*[c.alias(k) for k, c in _parsed(F.col("value")).items()])
