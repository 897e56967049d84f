"""Heads of rankings (O7, Q9) and partitioned stages."""

from __future__ import annotations

import os

from hypothesis import given, settings, strategies as st

from vidtrend.operators.rank import top_k
from vidtrend.plans import programs as P
from vidtrend.sources import write_stage


@settings(max_examples=10, deadline=None)
@given(st.lists(st.integers(min_value=0, max_value=5), max_size=30), st.integers(min_value=1, max_value=10))
def test_top_k_is_the_head_of_the_sorted_list(spark, values, k):
    data = [(f"c{i:02d}", v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "channel string, n bigint")
    got = [tuple(r) for r in top_k(df, "n", k, ["channel"]).select("channel", "n").collect()]
    assert got == sorted(data, key=lambda t: (-t[1], t[0]))[:k]


def test_head_of_modes(snapshots):
    report = P.channel_totals(snapshots)
    full = [tuple(r) for r in P.head_of(report, "views", ["channel"]).collect()]
    assert len(full) == 3
    first = [tuple(r) for r in P.head_of(report, "views", ["channel"], k=1).collect()]
    assert first == full[:1]
    ties = P.head_of(report, "dislikes", ["channel"], k=1, with_ties=True)
    assert [(r.dislikes, r.channel, r.rank) for r in ties.collect()] == [(5, "ChA", 1)]


def test_top_k_needs_a_positive_k(snapshots):
    import pytest
    with pytest.raises(ValueError):
        top_k(P.channel_totals(snapshots), "views", 0, ["channel"])


def test_partitioned_stage(spark, snapshots, tmp_path):
    path = str(tmp_path / "snaps")
    back = write_stage(snapshots, path, partition_by=["region"])
    assert sorted(d for d in os.listdir(path) if d.startswith("region=")) == ["region=IN", "region=US"]
    assert back.where("region = 'US'").count() == 4
