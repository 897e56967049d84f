"""Lines of UTF-16 files, split like any other text.

A file is cut at the two bytes of a line break, wherever its splits lie.  The same two
bytes can also stand across two characters (the second byte of one, the first of
the next).  Such a false cut leaves pieces with an odd number of bytes, and a cut
is a true one if the pieces before it hold an even number of bytes, that is an even
number of odd pieces.  Files without odd pieces are their lines as they are.  In the
others, odd pieces are counted per split and over a file's splits, lines are numbered
by the true cuts, and the pieces of a line are joined again.
"""

from __future__ import annotations

import codecs

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# Charset -> bytes of its line break.
LINE_BREAKS = {"UTF-16LE": b"\n\x00", "UTF-16BE": b"\x00\n"}
BYTE_ORDER_MARK = "﻿"


def byte_order(spark: SparkSession, file: str) -> str:
    """The charset a UTF-16 file says by its mark; big endian without one, as the
    standard has it.  Reads the file's first line."""
    first = spark.read.option("lineSep", "\n").text(file).select(F.col("value").cast("binary").alias("b")).take(1)
    return "UTF-16LE" if first and bytes(first[0].b).startswith(codecs.BOM_UTF16_LE) else "UTF-16BE"


def _pieces(spark: SparkSession, paths: list[str], charset: str) -> DataFrame:
    """What lies between the bytes of line breaks: file, start of the split, a number
    that grows along a split, and the bytes."""
    read = spark.read.option("encoding", charset).option("lineSep", "\n").text(paths)
    return read.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"),
                       F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("id"),
                       F.col("value").cast("binary").alias("bytes"))


def _odd(column: str = "bytes") -> Column:
    return (F.octet_length(column) % 2).cast("long")


def _rejoined(pieces: DataFrame, line_break: bytes) -> DataFrame:
    """(file_name, bytes) of whole lines, from pieces that false cuts broke."""
    along = Window.partitionBy("file", "split").orderBy("id")
    odd = pieces.withColumn("odd", F.sum(_odd()).over(along) % 2)   # within the split, up to and with this piece
    # per split: odd pieces, and true cuts if it begins after an even or an odd number of bytes
    splits = odd.groupBy("file", "split").agg(
        F.sum(_odd()).alias("n_odd"), F.sum(1 - F.col("odd")).alias("if_even"), F.sum("odd").alias("if_odd"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("shift", F.coalesce(F.sum("n_odd").over(before), F.lit(0)) % 2)
    cuts = F.when(F.col("shift") == 0, F.col("if_even")).otherwise(F.col("if_odd"))
    splits = (splits.withColumn("cuts", cuts)
              .withColumn("first", F.coalesce(F.sum("cuts").over(before), F.lit(0))).select("file", "split", "shift", "first"))
    true_cut = ((F.col("odd") + F.col("shift")) % 2 == 0).cast("long")
    numbered = (odd.join(splits, ["file", "split"])
                .withColumn("line", F.col("first") + F.sum(true_cut).over(along) - true_cut))
    parts = F.array_sort(F.collect_list(F.struct("split", "id", F.hex("bytes").alias("hex"))))
    # a line's pieces: as many as it has false cuts
    lines = numbered.groupBy("file", "file_name", "line").agg(parts.alias("parts"))
    return lines.select("file_name", F.unhex(F.array_join(F.col("parts.hex"), line_break.hex())).alias("bytes"))


def read_utf16_lines(spark: SparkSession, paths: list[str], charset: str) -> DataFrame:
    """Lines (``value``, ``file_name``) of UTF-16 files; ``charset`` UTF-16 takes each
    file's byte order from its mark.  Lines end at LF, CR or both, as in other text; a
    mark at the start of a line is dropped."""
    files = sorted(spark.read.text(paths).inputFiles())
    by_charset: dict[str, list[str]] = {}
    for file in files:
        by_charset.setdefault(byte_order(spark, file) if charset == "UTF-16" else charset, []).append(file)
    lines = None
    for name, own in by_charset.items():
        pieces = _pieces(spark, own, name)
        # a row per file: the files with false cuts
        broken = [r.file for r in pieces.groupBy("file").agg(F.max(_odd()).alias("odd")).where("odd > 0").collect()]
        whole = pieces.where(~F.col("file").isin(broken)) if broken else pieces
        found = whole.select("file_name", "bytes")
        if broken:
            found = found.unionByName(_rejoined(pieces.where(F.col("file").isin(broken)), LINE_BREAKS[name]))
        text = F.decode("bytes", name)
        text = F.when(F.startswith(text, F.lit(BYTE_ORDER_MARK)), F.substring(text, F.lit(2), F.length(text))).otherwise(text)
        decoded = found.select(F.explode(F.split(text, "\r", -1)).alias("value"), "file_name")
        lines = decoded if lines is None else lines.unionByName(decoded)
    return lines if lines is not None else spark.createDataFrame([], "value string, file_name string")
