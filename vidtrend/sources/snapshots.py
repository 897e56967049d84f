"""Snapshot CSV scan (S1-S3, S9) with the line rules P1, P3, P4, P7.

The file is read line by line (``spark.read.text``: splittable, one row per
line, file name in ``_metadata``) and each line is cut into fields at the commas
outside quotes, in generated code: no lambda runs per field.  A line
whose field count is not exactly 16 is dropped, whatever its length, and so is
a line with an unterminated quoted field.  Parsing per line on purpose: a
quoted field that spans lines is not joined, so both halves fail the field
count, as in the original programs.

Spark's CSV parser is *not* used.  ``spark.read.csv`` with column pruning (the
default) does not flag a short or long line when few columns are selected;
``from_csv`` fails the job on a line with more fields than its limit, and
splits at commas inside a quoted part of an unquoted field.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vidtrend.functions.text import java_trim, parse_int, parse_long
from vidtrend.schema import RAW_COLUMNS, SNAPSHOT_ARITY, SNAPSHOT_COLUMNS, STATS
from vidtrend.sources.wide_lines import read_utf16_lines

# Stand for a cut between fields, an escaped backslash and an escaped quote
# while a line is cut.  Noncharacters: no text holds them.
CUT, BACKSLASH, QUOTE = "\ufdd0", "\ufdd1", "\ufdd2"

# Charsets in which a line can be cut out before it is decoded.
LINE_CHARSETS = ("UTF-8", "US-ASCII", "ISO-8859-1")
WIDE_CHARSETS = ("UTF-16", "UTF-16LE", "UTF-16BE")


def _of_regions(path: str, regions: Sequence[str]) -> str:
    """A glob of what lies in folder ``path`` under names that begin with one of ``regions``."""
    if not regions or any(len(r) != 2 for r in regions):
        raise ValueError(f"regions must be two-letter codes, got {list(regions)!r}")
    names = [re.sub(r"([\[\]{}*?\\,])", r"\\\1", r) for r in regions]
    return f"{path.rstrip('/')}/{{{','.join(names)}}}*"


def read_snapshot_lines(spark: SparkSession, path: str | list[str],
                        encoding: str = "UTF-8", regions: Sequence[str] | None = None) -> DataFrame:
    """Raw lines of one file, a directory, a glob or a list of them (S2:
    several regional files are a UNION ALL).  Columns ``value`` and
    ``file_name``; other charsets than UTF-8 are decoded (S9).

    ``regions``: ``path`` is a folder (or several) of regional files, and only those
    of the regions are listed and read.  A regional file may be a folder of part
    files (``INvideos.csv/part-...``), as jobs write it; its name counts."""
    paths = [path] if isinstance(path, str) else list(path)
    if regions is not None:
        paths = [_of_regions(p, regions) for p in paths]
    if encoding.upper() in WIDE_CHARSETS:
        return read_utf16_lines(spark, paths, encoding.upper())
    name, folder = F.col("_metadata.file_name"), F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    own = F.when(F.startswith(name, F.lit("part-")), folder).otherwise(name)
    lines = spark.read.text(paths).select("value", plain_name(own).alias("file_name"))
    return decode_lines(lines, encoding)


def plain_name(name: Column) -> Column:
    """A file's name as it is in its folder; Spark gives it as part of an address."""
    return F.when(F.contains(name, F.lit("%")), F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B")))).otherwise(name)


def decode_lines(lines: DataFrame, encoding: str) -> DataFrame:
    """``value``, the bytes of each line, read in ``encoding``."""
    enc = encoding.upper()
    if enc not in LINE_CHARSETS:
        raise ValueError(f"encoding {encoding!r} not supported line by line; use one of {LINE_CHARSETS}")
    if enc == "UTF-8":
        return lines
    return lines.withColumn("value", F.decode(F.col("value").cast("binary"), enc))


def region_from_file_name(file_name: str | Column = "file_name") -> Column:
    """S3: the region is the first two characters of the file name."""
    c = F.col(file_name) if isinstance(file_name, str) else file_name
    return F.substring(c, 1, 2)


def _escapes_set_aside(line: Column, escape: str) -> Column:
    """Escaped quotes (and, with backslashes, escaped backslashes) become stand-ins."""
    if escape == "backslash":
        out = F.replace(line, F.lit("\\\\"), F.lit(BACKSLASH))
        out = F.replace(out, F.lit('\\"'), F.lit(QUOTE))
        # a backslash that escapes nothing is dropped, as the original parser does
        out = F.replace(out, F.lit("\\"), F.lit(""))
        line = F.when(F.contains(line, F.lit("\\")), out).otherwise(line)
    return line


def _fields(line: Column, n_quotes: Column) -> Column:
    """The raw fields of a line without open quotes: cut at the commas that lie
    outside quoted parts, wherever in a field a quoted part begins.

    A line without quotes is split as it is, one with a single quoted part before and
    behind it.  In the others the first pass puts a cut behind every quoted part and in
    place of every comma outside of them; the second takes the cuts behind quoted parts
    away.  Both patterns run through a line once, whatever its length."""
    comma, cut, quote = F.lit(","), F.lit(CUT), F.lit('"')
    before, behind = F.substring_index(line, '"', 1), F.substring_index(line, '"', -1)
    between = F.substring(line, F.length(before) + 1, F.length(line) - F.length(before) - F.length(behind))
    single = F.concat(F.replace(before, comma, cut), between, F.replace(behind, comma, cut))
    quoted = '("[^"]*+")'
    cuts = F.regexp_replace(line, quoted + "|,", "$1" + CUT)
    several = F.regexp_replace(cuts, quoted + CUT, "$1")
    return (F.when(~F.contains(line, quote), F.split(line, ",", -1))
            .otherwise(F.split(F.when(n_quotes == 2, single).otherwise(several), CUT, -1)))


def _unquoted(field: Column) -> Column:
    """A trimmed field without the quotes around it; a doubled quote inside them
    is a literal quote."""
    quote = F.lit('"')
    around = (F.octet_length(field) >= 2) & F.startswith(field, quote) & F.endswith(field, quote)
    inner = F.substring(field, F.lit(2), F.length(field) - 2)
    return F.when(around, F.replace(inner, F.lit('""'), quote)).otherwise(field)


def _restored(field: Column) -> Column:
    """Escaped characters instead of their stand-ins, in the lines that have some."""
    out = field
    for stand_in, char in ((BACKSLASH, "\\"), (QUOTE, '"')):
        out = F.replace(out, F.lit(stand_in), F.lit(char))
    return F.when(F.col("escaped"), out).otherwise(field)


def _step(rows: DataFrame, others: list[str], columns: dict[str, Column]) -> DataFrame:
    """``rows`` with ``columns`` computed, each once: a generator holds them, so that
    neither later steps nor filters repeat them.  Steps of small expressions stay
    small methods of generated code, which the virtual machine compiles."""
    held = F.struct(*[c.alias(name) for name, c in columns.items()])
    return rows.select(*others, F.explode(F.array(held)).alias("step")).select(*others, "step.*")


def parse_snapshot_lines(lines: DataFrame, value: str = "value",
                         region: Column | str | None = None,
                         escape: str = "backslash") -> DataFrame:
    """Lines -> snapshots (schema ``SNAPSHOT_SCHEMA``).

    Keeps every line with exactly 16 fields, header lines included (programs
    differ in whether they drop them, see ``operators.clean``).  Text fields
    are trimmed; counts and the category id are parsed and are null when they
    do not parse.

    ``escape``: ``"backslash"`` (the original parser's default) reads ``\\"``
    as a literal quote and ``\\\\`` as a backslash, and drops any other
    backslash; ``"double"`` leaves backslashes alone.  Either way a doubled
    quote inside a quoted field is a literal quote.
    """
    if escape not in ("backslash", "double"):
        raise ValueError(f"escape must be 'backslash' or 'double', got {escape!r}")
    if region is None:
        region_col = region_from_file_name()
    elif isinstance(region, str):
        region_col = F.lit(region)
    else:
        region_col = region
    # Generators keep each step's result: the optimizer cannot push the
    # validity filters below them, which would repeat the work per filter.
    cut = (lines.where(F.length(F.col(value)) > 0)                           # P7
           .select(region_col.alias("region"),
                   F.explode(F.array(_escapes_set_aside(F.col(value), escape))).alias("line")))
    # A quoted field left open at the end of the line (it continues on the
    # next physical line) makes the original per-line parser come up short of
    # fields: an odd number of quotes.  Counted in bytes; the quote byte never
    # occurs inside a multi-byte UTF-8 character.
    n_quotes = F.octet_length("line") - F.octet_length(F.replace("line", F.lit('"'), F.lit("")))
    escaped = F.contains("line", F.lit(BACKSLASH)) | F.contains("line", F.lit(QUOTE))
    rows = (cut.where(~F.contains("line", F.lit('"')) | (n_quotes % 2 == 0))  # P1
            .select("region", escaped.alias("escaped"), F.explode(F.array(_fields(F.col("line"), n_quotes))).alias("f"))
            .where(F.size("f") == SNAPSHOT_ARITY))                           # P1
    used = ("video_id", "title", "channel", "category_raw", "views_raw", "likes_raw", "dislikes_raw", "comments_raw")
    names, kept = {c: F.get("f", F.lit(RAW_COLUMNS.index(c))) for c in used}, ["region", "escaped"]
    text = _step(rows, kept, {c: java_trim(raw) for c, raw in names.items()})                # P3
    for rule in (_unquoted, _restored, java_trim):
        text = _step(text, kept, {c: rule(F.col(c)) for c in used})
    words = ["region", "video_id", "title", "channel", "category_raw"]
    numbers = {"category_id": parse_int("category_raw")} | {c: parse_long(f"{c}_raw") for c in STATS}   # P4
    return _step(text, words, numbers).select(*SNAPSHOT_COLUMNS)


def read_snapshots(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8",
                   region: str | None = None, escape: str = "backslash",
                   regions: Sequence[str] | None = None) -> DataFrame:
    """Scan regional snapshot CSV files into typed snapshots.

    ``region`` overrides the region taken from each file name; ``regions`` reads only
    the files of those regions (``read_snapshot_lines``)."""
    lines = read_snapshot_lines(spark, path, encoding, regions)
    return parse_snapshot_lines(lines, region=region, escape=escape)


def union_snapshots(*frames: DataFrame) -> DataFrame:
    """UNION ALL of snapshot frames loaded separately (duplicates kept;
    de-duplication is the programs' job)."""
    if not frames:
        raise ValueError("no snapshot frames given")
    return reduce(lambda a, b: a.unionByName(b), [f.select(*SNAPSHOT_COLUMNS) for f in frames])
