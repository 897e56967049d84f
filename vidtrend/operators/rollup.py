"""Aggregations (A1-A5); Spark combines map-side before every shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vidtrend.schema import STATS


def count_by(df: DataFrame, key: str = "channel", name: str = "n") -> DataFrame:
    """A1 / A2: rows per ``key``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def totals_by(df: DataFrame, key: str) -> DataFrame:
    """A3 / A4: the four statistics summed per ``key``."""
    return df.groupBy(key).agg(*[F.sum(c).alias(c) for c in STATS])


def views_by(df: DataFrame, key: str = "label") -> DataFrame:
    """A5: views summed per ``key``."""
    return df.groupBy(key).agg(F.sum("views").alias("views"))
