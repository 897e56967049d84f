"""The benchmark-table model exercises the rules it is meant to exercise."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from vidtrend.plans import model

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="benchmark tables not present")


def test_snapshots_cover_the_rules(spark):
    snaps = model.snapshots(spark, SF_DIR)
    assert snaps.count() == spark.read.parquet(f"{SF_DIR}/lineitem.parquet").count()
    regions = {r.region for r in snaps.select("region").distinct().collect()}
    assert regions == {"AF", "AM", "AS", "EU", "MI"}
    codes = {r.video_id for r in snaps.where(F.col("video_id").startswith("#")).select("video_id").distinct().collect()}
    assert codes == {"#NAME?", "#VALUE!"}


def test_dictionary_leaves_fallbacks(spark):
    cats = model.categories(spark, SF_DIR)
    assert cats.where((F.col("region") == "MI") | (F.col("category_id") == 29)).count() == 0
    assert cats.groupBy("region", "category_id").count().where("count > 1").count() == 0
    titles = {r.title for r in cats.select("title").distinct().collect()}
    assert len(titles) <= model.TITLE_BUCKETS  # ids share titles


def test_variants_bite(spark):
    names = ["region", "video_id", "category_raw"]
    bad = model.late_snapshots(spark, SF_DIR, bad_categories=True).frame(names).where("category_raw = 'x'")
    assert {r.region for r in bad.select("region").distinct().collect()} >= {"AM", "MI"}
    tied = model.late_snapshots(spark, SF_DIR, tied_views=True).frame(names).groupBy("video_id").agg(F.countDistinct("likes").alias("n"))
    assert tied.where("n > 1").count() > 100


def test_building_a_query_starts_no_job(spark):
    import __spark_entry__
    from vidtrend.plans import catalog
    tracker = spark.sparkContext.statusTracker()
    for name, build in catalog.queries().items():
        spark.sparkContext.setJobGroup(f"build-{name}", name)
        if name in catalog.WRITES_FILES:
            continue
        build(spark, SF_DIR)
        assert not tracker.getJobIdsForGroup(f"build-{name}"), name
    spark.sparkContext.setJobGroup("tests", "tests")
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
