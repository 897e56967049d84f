"""Category dictionaries.

One JSON document per region, ``<REGION>_category_id.json``:
``{"items": [{"id": "10", "snippet": {"title": "Music"}}, ...]}``.
The result is the lookup table ``(region, category_id, title)``.  A region
whose document has no usable item keeps one row with a null id, so that the
region still counts as known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vidtrend.schema import DICTIONARY_SCHEMA


def categories_from_documents(docs: DataFrame, items: str = "items",
                              region: str | Column = "region") -> DataFrame:
    """Explode parsed dictionary documents.  A duplicated id keeps the title of
    its last item (later entries overwrite earlier ones)."""
    region_col = F.col(region) if isinstance(region, str) else region
    exploded = docs.select(region_col.alias("region"),
                           F.posexplode_outer(F.col(items)).alias("pos", "item"))
    typed = exploded.select(
        "region", "pos",
        F.col("item.id").try_cast("int").alias("category_id"),
        F.col("item.snippet.title").alias("title"),
    )
    return (typed.groupBy("region", "category_id")
            .agg(F.max_by("title", "pos").alias("title"))
            .select("region", "category_id",
                    F.when(F.col("category_id").isNotNull(), F.col("title")).alias("title")))


def read_categories(spark: SparkSession, path: str | list[str],
                    region: str | None = None) -> DataFrame:
    """All dictionaries under ``path`` (region = first two characters of
    each file name).  S5: with ``region`` only that region's dictionary."""
    if region is not None and len(region) != 2:
        raise ValueError(f"region must be a two-letter code, got {region!r}")
    paths = [path] if isinstance(path, str) else list(path)
    docs = (spark.read.schema(DICTIONARY_SCHEMA).option("multiLine", True).json(paths)
            .select("items", F.substring(F.col("_metadata.file_name"), 1, 2).alias("region")))
    if region is not None:
        docs = docs.where(F.col("region") == region)
    return categories_from_documents(docs)
