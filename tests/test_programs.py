"""The programs on the hand-written fixture; expected values worked out by hand."""

from __future__ import annotations

import pytest

from vidtrend.plans import programs as P


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_q1_channel_row_count(snapshots):
    got = dict(rows(P.channel_row_count(snapshots)))
    assert got == {"ChA": 7, "ChB": 4, "ChC": 1, "ChD": 2, "channel_title": 2}


def test_q2_channel_video_ranking(snapshots):
    got = rows(P.channel_video_ranking(snapshots))
    assert got == [(4, "ChB"), (2, "ChA"), (2, "ChD"), (1, "")]


def test_q2_top_k_keeps_ties(snapshots):
    got = rows(P.top_channels_by_video_count(snapshots, 2))
    assert got == [(4, "ChB", 1), (2, "ChA", 2), (2, "ChD", 2)]
    got = rows(P.top_channels_by_video_count(snapshots, 4))
    assert got == [(4, "ChB", 1), (2, "ChA", 2), (2, "ChD", 2), (1, "", 4)]
    assert rows(P.top_channels_by_video_count(snapshots, 1)) == [(4, "ChB", 1)]


def test_q3_q4_channel_stats(snapshots):
    assert rows(P.channel_stats(snapshots, "views")) == [
        (440, "ChB", 39, 4, 16), (300, "ChA", 5, 5, 5), (160, "ChD", 17, 3, 3)]
    assert rows(P.channel_stats(snapshots, "likes")) == [
        (39, "ChB", 440, 4, 16), (17, "ChD", 160, 3, 3), (5, "ChA", 300, 5, 5)]
    assert rows(P.channel_stats(snapshots, "dislikes")) == [
        (5, "ChA", 300, 5, 5), (4, "ChB", 440, 39, 16), (3, "ChD", 160, 17, 3)]
    assert rows(P.channel_stats(snapshots, "comments")) == [
        (16, "ChB", 440, 39, 4), (5, "ChA", 300, 5, 5), (3, "ChD", 160, 17, 3)]
    assert rows(P.most_viewed_channels(snapshots)) == rows(P.channel_stats(snapshots, "views"))
    assert rows(P.top_viewed_channels(snapshots, 2)) == [
        (440, "ChB", 39, 4, 16), (300, "ChA", 5, 5, 5)]


def test_q5_category_stats_in(snapshots, categories):
    got = rows(P.category_stats(snapshots, categories, "IN", "views"))
    assert got == [
        (300, "IN_29", 5, 5, 5, 29), (300, "Music", 30, 3, 15, 10),
        (80, "Entertainment", 3, 1, 1, 24), (80, "IN_23", 9, 2, 2, 23), (80, "IN_34", 8, 1, 1, 34)]


def test_q5_category_stats_us(snapshots, categories):
    got = rows(P.category_stats(snapshots, categories, "US", "views"))
    assert got == [
        (300, "Music", 30, 3, 15, 10), (300, "US_29", 5, 5, 5, 29),
        (80, "Comedy", 9, 2, 2, 23), (80, "Comedy", 8, 1, 1, 34), (80, "US_24", 3, 1, 1, 24)]
    likes = rows(P.category_stats(snapshots, categories, "US", "likes"))
    assert likes[0] == (30, "Music", 300, 3, 15, 10)


def test_q5_region_must_be_two_letters(snapshots, categories):
    with pytest.raises(ValueError):
        P.category_stats(snapshots, categories, "IND", "views")


def test_q6_video_stats(snapshots):
    assert rows(P.video_stats(snapshots, "views")) == [
        (300, "v1", "Song, one (new)", 30, 3, 15),
        (300, "v2", "Show", 5, 5, 5),
        (80, "v10", "Laugh", 8, 1, 1),
        (80, "v11", "Laugh2", 9, 2, 2),
        (70, "N/A", "Broken", 2, 0, 0),
        (60, "v8", "BadCat", 6, 0, 0),
        (10, "v9", "Pad", 1, 1, 1),
    ]
    by_comments = rows(P.video_stats(snapshots, "comments"))
    assert by_comments[0] == (15, "v1", "Song, one (new)", 300, 30, 3)


def test_title_keyed_videos(snapshots):
    assert rows(P.title_keyed_videos(snapshots)) == [("N/A", "Broken", 70, 2, 0, 0)]


def test_q7_category_views(snapshots, categories):
    got = dict(rows(P.category_views(snapshots, categories)))
    assert got == {"Comedy": 160, "Entertainment": 170, "IN_29": 300, "Music": 750}


def test_q8_correlations(snapshots):
    got = {(a, b): r for a, b, r in rows(P.stat_correlation(snapshots, digits=6))}
    assert got == {
        ("views", "likes"): 0.642495, ("views", "dislikes"): 0.858082,
        ("views", "comments"): 0.82017, ("likes", "dislikes"): 0.352763,
        ("likes", "comments"): 0.923077, ("dislikes", "comments"): 0.600003,
    }


def test_unknown_statistic_rejected(snapshots):
    with pytest.raises(ValueError):
        P.channel_stats(snapshots, "shares")
