"""Properties: top-k with ties equals a brute-force rank; results do not depend
on partitioning or row order; de-duplication is idempotent; channel and
category totals agree."""

from __future__ import annotations

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from vidtrend.operators.clean import REQUIRE_STATS_AND_CATEGORY, valid_rows, with_identity
from vidtrend.operators.dedup import best_channel_snapshot
from vidtrend.operators.rank import top_k_with_ties
from vidtrend.plans import programs as P


def brute_top_k(values, k):
    out = []
    for name, v in values:
        rank = 1 + sum(1 for _, w in values if w > v)
        if rank <= k:
            out.append((v, name, rank))
    return sorted(out, key=lambda t: (t[2], t[1]))


@settings(max_examples=15, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=6), min_size=0, max_size=25),
       st.integers(min_value=1, max_value=8))
def test_top_k_with_ties_matches_brute_force(spark, values, k):
    data = [(f"c{i:02d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "channel string, n bigint")
    got = [tuple(r) for r in top_k_with_ties(df, "n", k, ["channel"]).select("n", "channel", "rank").collect()]
    assert got == brute_top_k(data, k)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_partitioning_and_order_do_not_matter(snapshots, categories):
    shuffled = snapshots.repartition(7).orderBy(F.rand(3))
    for fn in (P.channel_row_count, P.channel_video_count, P.channel_totals, P.video_table):
        assert rows(fn(snapshots)) == rows(fn(shuffled))
    assert rows(P.category_views(snapshots, categories)) == rows(P.category_views(shuffled, categories))
    assert rows(P.category_totals(snapshots, categories, "IN")) == \
        rows(P.category_totals(shuffled, categories, "IN"))


def test_dedup_is_idempotent(snapshots):
    once = best_channel_snapshot(with_identity(valid_rows(snapshots)))
    again = best_channel_snapshot(once)
    assert rows(once) == rows(again)


def test_channel_totals_equal_category_totals(snapshots, categories):
    # on rows valid for both programs the best snapshots are the same videos
    both = valid_rows(snapshots, REQUIRE_STATS_AND_CATEGORY)
    ch = P.channel_totals(both).agg(*[F.sum(c) for c in ("views", "likes", "dislikes", "comments")])
    cat = P.category_totals(both, categories, "IN").agg(
        *[F.sum(c) for c in ("views", "likes", "dislikes", "comments")])
    assert rows(ch) == rows(cat)
