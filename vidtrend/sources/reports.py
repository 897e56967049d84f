"""Read a written report or stage file back (tab separated, no quoting)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from vidtrend.sources.sinks import ESCAPES

# Stands for an escaped backslash while the others are undone; no text holds it.
_BACKSLASH = "\ufdd1"


def _unescaped(field: Column) -> Column:
    (slash, two), *others = ESCAPES
    out = F.replace(field, F.lit(two), F.lit(_BACKSLASH))
    for char, written in others:
        out = F.replace(out, F.lit(written), F.lit(char))
    return F.when(F.contains(field, F.lit(slash)), F.replace(out, F.lit(_BACKSLASH), F.lit(slash))).otherwise(field)


def parse_report_lines(lines: DataFrame, schema: T.StructType | str, value: str = "value",
                       keep: Sequence[str] = ()) -> DataFrame:
    """Report lines -> rows.  Lines whose fields do not fit ``schema`` (wrong
    count, a header line, a number that does not parse) are dropped; an empty
    text field is '' as in the data model, an empty number is null.  ``keep``: columns
    of ``lines`` that stay beside."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    cut = lines.where(F.length(F.col(value)) > 0).select(*keep, F.explode(F.array(F.split(F.col(value), "\t", -1))).alias("f"))
    rows, fits, cols = cut, F.size("f") == len(schema.fields), []
    for k, f in enumerate(schema.fields):
        raw = F.get("f", F.lit(k))
        if isinstance(f.dataType, T.StringType):
            cols.append(_unescaped(raw).alias(f.name))
        else:
            number = raw.try_cast(f.dataType)
            fits = fits & ((raw == "") | number.isNotNull())
            cols.append(number.alias(f.name))
    return rows.where(fits).select(*cols, *keep)


def read_report(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """``parse_report_lines`` over the files of ``path``."""
    return parse_report_lines(spark.read.text([path] if isinstance(path, str) else list(path)), schema)


def read_report_head(spark: SparkSession, path: str, schema: T.StructType | str, k: int, header: int = 0) -> DataFrame:
    """The first ``k`` lines of a written report, after ``header`` header
    lines, in the order of its part files, with their ``position`` from 0.

    Nothing is sorted.  Part files are taken in order, twice as many each time, until
    those taken hold enough lines; of these, only the lines per split are counted and
    added up, which places every line.  Lines that do not fit ``schema`` are dropped
    but count."""
    if k < 1:
        raise ValueError("k must be positive")
    files = sorted(spark.read.text(path).inputFiles())
    wanted, taken = k + header, min(1, len(files))
    while True:
        lines = spark.read.text(files[:taken]) if taken else spark.createDataFrame([], "value string")
        if not taken:
            break
        # a line's number within its split: splits are read from their start, and numbers grow by one
        lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                             F.monotonically_increasing_id().alias("id"))
        splits = lines.groupBy("file", "split").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
        if taken == len(files) or (splits.agg(F.sum("n")).first()[0] or 0) >= wanted:
            break
        taken = min(2 * taken, len(files))
    if not taken:
        return parse_report_lines(lines, schema).withColumn("position", F.lit(0).cast("bigint"))
    # the splits of the files that hold the head
    before = Window.orderBy("file", "split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).where(F.col("before") < wanted).drop("n")
    place = F.col("before") + F.col("id") - F.col("first") - header
    head = (lines.join(splits, ["file", "split"]).select("value", place.alias("position"))
            .where(F.col("position").between(0, k - 1)))
    return parse_report_lines(head, schema, keep=["position"])
