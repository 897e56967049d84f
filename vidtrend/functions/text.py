"""Text-to-value rules of the snapshot fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vidtrend.schema import TRIM_CHARS


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: str | Column) -> Column:
    """An empty CSV field is ``null`` in Spark's parser; the data model wants ''."""
    return F.coalesce(_col(c), F.lit(""))


def java_trim(c: str | Column) -> Column:
    """Strip every character <= U+0020 at both ends (NBSP and other Unicode
    spaces are kept).  Null stays null.  Only text that starts or ends with
    such a character is trimmed: most fields need no work."""
    c = _col(c)
    padded = (F.left(c, F.lit(1)) <= " ") | (F.right(c, F.lit(1)) <= " ")
    return F.when(padded, F.btrim(c, F.lit(TRIM_CHARS))).otherwise(c)


def _number(c: str | Column, kind: str) -> Column:
    """The cast alone would strip control characters that the trim keeps, and
    take text such as ``1.5``; only signed digits are numbers."""
    text = java_trim(c)
    return F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast(kind))


def parse_long(c: str | Column) -> Column:
    """Trimmed text -> bigint; anything that is not an optionally signed run of
    digits in range gives null (never an error, ANSI mode or not)."""
    return _number(c, "bigint")


def parse_int(c: str | Column) -> Column:
    """Trimmed text -> int, null when it does not parse or overflows."""
    return _number(c, "int")
