"""Category dictionary lookups.

Both sides of a lookup are small: totals per category, and one row per (region,
category) of the dictionaries.  No hint is given: the planner and adaptive
execution choose the join from the measured sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vidtrend.schema import LABEL_SEP


def fallback_label(region, category) -> F.Column:
    """``REGION_id`` for a category without a dictionary title."""
    return F.concat_ws(LABEL_SEP, region, category)


def label_one_region(totals: DataFrame, categories: DataFrame, region: str) -> DataFrame:
    """Label category totals with the dictionary of one ``region``; an id
    without a title becomes ``<region>_<id>`` with the given region, whatever
    regions the totals came from.  Adds ``label``."""
    if len(region) != 2:
        raise ValueError(f"region must be a two-letter code, got {region!r}")
    lookup = (categories.where((F.col("region") == region) & F.col("category_id").isNotNull())
              .select("category_id", F.col("title").alias("_title")))
    joined = totals.join(lookup, "category_id", "left")
    label = F.coalesce(F.col("_title"),
                       fallback_label(F.lit(region), F.col("category_id").cast("string")))
    return joined.withColumn("label", label).drop("_title")


def label_by_region(rows: DataFrame, categories: DataFrame) -> DataFrame:
    """Label rows ``(region, category_raw, category_id, ...)`` with their
    own region's dictionary.  Adds ``label``.

    * region without a dictionary: ``<region>_<raw id>``;
    * region with one, id not a number: the row is dropped;
    * id not in the dictionary, or no title: ``<region>_<raw id>``.

    One join on (region, id): only a row without a number needs to know whether
    its region has a dictionary, and every region with one has a null id in it.
    """
    titles = categories.select("region", F.col("category_id").alias("_id"), F.col("title").alias("_title"))
    known = titles.select("region", F.lit(None).cast("int").alias("_id"), F.lit(None).cast("string").alias("_title"))
    lookup = (titles.where(F.col("_id").isNotNull()).unionByName(known.distinct())
              .select(F.col("region").alias("_region"), "_id", "_title", F.lit(True).alias("_found")))
    joined = rows.join(lookup, (F.col("region") == F.col("_region")) & F.col("category_id").eqNullSafe(F.col("_id")), "left")
    label = F.coalesce(F.col("_title"), fallback_label(F.col("region"), F.col("category_raw")))
    return (joined.where(F.col("category_id").isNotNull() | F.col("_found").isNull())
            .withColumn("label", label).drop("_region", "_id", "_title", "_found"))
