"""Report and stage writers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


# What would break a line, and how it is written; a backslash comes first.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def _escaped(field: Column) -> Column:
    for char, written in ESCAPES:
        field = F.replace(field, F.lit(char), F.lit(written))
    return field


def to_tsv_lines(df: DataFrame) -> DataFrame:
    """One ``value`` line per row: fields joined by a tab, null as ''; a tab,
    line break or backslash inside a text is written as a backslash escape,
    which ``sources.reports`` undoes.
    (``write.csv(sep='\\t')`` would quote empty strings and escape quotes.)"""
    text = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    fields = [F.coalesce(_escaped(F.col(f"`{c}`")) if c in text else F.col(f"`{c}`").cast("string"), F.lit(""))
              for c in df.columns]
    return df.select(F.concat_ws("\t", *fields).alias("value"))


def write_report(df: DataFrame, path: str, fmt: str = "tsv", header: list[str] | None = None,
                 mode: str = "overwrite") -> None:
    """Write a (ranked) report.  Row order is kept: a globally sorted frame is
    written partition by partition, part files in sort order.

    ``header`` adds a first line (TSV only).
    """
    if fmt == "parquet":
        df.write.mode(mode).parquet(path)
        return
    if fmt != "tsv":
        raise ValueError(f"unknown report format {fmt!r}")
    lines = to_tsv_lines(df)
    if header:
        spark = df.sparkSession
        head = spark.createDataFrame([("\t".join(header),)], "value string")
        # Union keeps partition order: the header partition comes first.
        lines = head.union(lines)
    lines.write.mode(mode).text(path)


def write_stage(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: list[str] | None = None) -> DataFrame:
    """Keep an intermediate result (e.g. the deduplicated videos) as
    parquet in a shared folder and continue from the written copy.  Several
    rankings then read it instead of recomputing it, and a lost executor
    costs a re-read, not a recomputation from the raw files.

    ``partition_by=["region"]`` on parsed snapshots turns a later filter on
    the region into partition pruning."""
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    spark: SparkSession = df.sparkSession
    return spark.read.parquet(path)


# Beside a bucketed stage's files, in a folder that readers of the files skip.
BUCKETING = "_bucketing"


def write_bucketed_stage(df: DataFrame, path: str, key: str, buckets: int | None = None,
                         mode: str = "overwrite") -> DataFrame:
    """A parquet stage bucketed and sorted by ``key``.  Programs that group by
    the key, in this session or a later one (``read_bucketed_stage``), aggregate it
    without an exchange.  ``buckets`` is a setting of the data: by default the
    session's number of shuffle partitions.  The rows should be reduced first
    (``reduced_snapshots``), as all rows of a key lie in one bucket."""
    spark: SparkSession = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"stage_{uuid.uuid4().hex}"
    (df.repartition(buckets, key).write.mode(mode).bucketBy(buckets, key).sortBy(key)
     .option("path", path).saveAsTable(table))
    spark.sql(f"DROP TABLE {table}")  # an external table: the files stay
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    kept = spark.createDataFrame([(key, buckets, columns)], "key string, buckets int, columns string")
    kept.coalesce(1).write.mode(mode).json(os.path.join(path, BUCKETING))
    return read_bucketed_stage(spark, path)


def read_bucketed_stage(spark: SparkSession, path: str) -> DataFrame:
    """A stage of ``write_bucketed_stage``, with its bucketing."""
    kept = spark.read.schema("key string, buckets int, columns string").json(os.path.join(path, BUCKETING)).first()
    if kept is None:
        raise ValueError(f"{path} holds no bucketed stage")
    table, location = f"stage_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"CREATE TABLE {table} ({kept.columns}) USING parquet CLUSTERED BY (`{kept.key}`) "
              f"SORTED BY (`{kept.key}`) INTO {kept.buckets} BUCKETS LOCATION '{location}'")
    stage = spark.table(table)
    spark.sql(f"DROP TABLE {table}")  # the frame is bound to the files
    return stage
