from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vidtrend.session import build_session  # noqa: E402

HEADER = ("video_id,trending_date,title,channel_title,category_id,publish_time,tags,views,"
          "likes,dislikes,comment_count,thumbnail_link,comments_disabled,ratings_disabled,"
          "video_error_or_removed,description")


def line(vid, title, channel, cat, views, likes, dislikes, comments, n_fields=16):
    fields = [vid, "x", title, channel, cat, "x", "x", views, likes, dislikes, comments,
              "x", "x", "x", "x", "x"]
    if n_fields < 16:
        fields = fields[:n_fields]
    elif n_fields > 16:
        fields = fields + ["x"] * (n_fields - 16)
    return ",".join(fields)


# Hand-written fixture: every edge rule of the scan, identity and dedup.
IN_LINES = [
    HEADER,
    line("v1", '"Song, one"', "ChA", "10", "100", "10", "1", "5"),
    line("v1", '"Song, one (new)"', "ChB", "10", "300", "30", "3", "15"),
    line("v1", '"Song, one"', "ChA", "10", "200", "20", "2", "10"),
    line("v2", "Show", "ChA", "29", "300", "5", "5", "5"),
    line("v3", "Zero", "ChC", "24", "0", "1", "1", "1"),
    line("#NAME?", "Broken", "ChA", "24", "50", "1", "0", "0"),
    line("#VALUE!", "Broken", "ChB", "24", "70", "2", "0", "0"),
    line("v4", "Bad", "ChA", "24", "abc", "1", "1", "1"),
    line("v5", "Short", "ChA", "24", "9", "1", "1", "1", n_fields=15),
    line("v6", "Long", "ChA", "24", "9", "1", "1", "1", n_fields=17),
    "",
    line("v7", "NoLikes", "ChA", "24", "40", "", "1", "1"),
    line("v8", "BadCat", "ChB", "x", "60", "6", "0", "0"),
    line("  v9  ", " Pad ", " ChB ", "24", "10", "1", "1", "1"),
]
US_LINES = [
    HEADER,
    line("v1", '"Song, one"', "ChA", "10", "250", "25", "2", "12"),
    line("v10", "Laugh", "ChD", "34", "80", "8", "1", "1"),
    line("v11", "Laugh2", "ChD", "23", "80", "9", "2", "2"),
]
DICTIONARIES = {
    "IN": {"10": "Music", "24": "Entertainment"},
    "US": {"10": "Music", "23": "Comedy", "34": "Comedy"},
}


def write_fixture(root: str) -> tuple[str, str]:
    csv_dir = os.path.join(root, "csv")
    json_dir = os.path.join(root, "json")
    os.makedirs(csv_dir)
    os.makedirs(json_dir)
    for region, lines in (("IN", IN_LINES), ("US", US_LINES)):
        with open(os.path.join(csv_dir, f"{region}videos.csv"), "w", encoding="utf-8") as f:
            f.write("\n".join(lines) + "\n")
    for region, cats in DICTIONARIES.items():
        doc = {"kind": "list", "items": [{"id": k, "snippet": {"title": v}} for k, v in cats.items()]}
        with open(os.path.join(json_dir, f"{region}_category_id.json"), "w", encoding="utf-8") as f:
            json.dump(doc, f, indent=2)
    return csv_dir, json_dir


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def fixture_dirs():
    root = tempfile.mkdtemp(prefix="vidtrend-fixture-")
    return write_fixture(root)


@pytest.fixture(scope="session")
def snapshots(spark, fixture_dirs):
    from vidtrend.sources import read_snapshots
    return read_snapshots(spark, fixture_dirs[0])


@pytest.fixture(scope="session")
def categories(spark, fixture_dirs):
    from vidtrend.sources import read_categories
    return read_categories(spark, fixture_dirs[1])
