"""From raw documents to packed training sequences, in five stages.

Each stage reads what its predecessor kept, as Parquet in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidtrend.llm import decontaminate, linededup, quality, queries, simhash
from vidtrend.llm.common import keep, table

DOCUMENTS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs.select(*DOCUMENTS), model).where("predicted = 1").select(*DOCUMENTS)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    kept = linededup.drop_frequent_lines(docs.select(*DOCUMENTS), min_docs=10, min_chars=1)
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*DOCUMENTS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash.one_of_each(docs.select(*DOCUMENTS), shingle=3, max_bits=2)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.clean(docs.select(*DOCUMENTS), table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents left, in token sequences."""
    return queries.packed(docs)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("packing", packing),
]

#: The classifier is trained and texts are tokenized, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
