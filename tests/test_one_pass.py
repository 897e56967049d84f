"""Late lookup, one dedup for all programs, and bucketed stages: each gives what
the single programs give over the plain snapshots."""

from __future__ import annotations

import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from tests.conftest import write_fixture
from vidtrend import cli
from vidtrend.operators.late import LateSnapshots, reduced_snapshots
from vidtrend.plans import programs as P
from vidtrend.schema import SNAPSHOT_SCHEMA, STATS
from vidtrend.sources import read_bucketed_stage, write_bucketed_stage
from tests.test_cli import lines


def rows(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=repr)


def odd_snapshots(spark, seed=1, n=900):
    """Ties, nulls in every column, headers, error codes, zero and negative views."""
    rng = random.Random(seed)
    pick = lambda *values: rng.choice(values)
    number = lambda: pick(None, -1, 0, 0, 1, 2, 3)
    data = []
    for _ in range(n):
        category = pick("10", "24", "x", "", "99999999999")
        data.append((pick("IN", "US", None), pick("v1", "v2", "v3", "#NAME?", "#VALUE!", "video_id", "", None, "T1"), pick("T1", "T2", "#NAME?", None),
                     pick("A", "B", "", None), category, int(category) if category in ("10", "24") else None, number(), number(), number(), number()))
    return spark.createDataFrame(data, SNAPSHOT_SCHEMA)


def answers(snaps, categories):
    return {"rows": rows(P.channel_row_count(snaps)), "videos": rows(P.channel_video_count(snaps)), "channels": rows(P.channel_totals(snaps)),
            "categories": rows(P.category_totals(snaps, categories, "IN")), "table": rows(P.video_table(snaps)),
            "views": rows(P.category_views(snaps, categories)), "correlation": rows(P.stat_correlation(snaps, digits=9))}


def late_of(snaps):
    """The snapshots as facts with a number for each name, and tables of the names."""
    columns = ["region", "video_id", "title", "channel", "category_raw", "category_id"]
    tables, facts = {}, snaps
    for c in columns:
        values = sorted({r[0] for r in snaps.select(c).collect()}, key=repr)
        frame = snaps.sparkSession.createDataFrame(list(enumerate(values)), f"k_{c} int, {c} {snaps.schema[c].dataType.simpleString()}")
        tables[c] = frame
        facts = facts.alias("f").join(frame.alias("t"), F.col(f"f.{c}").eqNullSafe(F.col(f"t.{c}"))).select("f.*", f"k_{c}")
    facts = facts.drop(*columns)
    keys = {c: (f"k_{c}",) for c in columns} | {"identity": ("k_video_id", "k_title"), "token": ("k_video_id", "k_title")}

    def look_up(found, wanted):
        from vidtrend.functions.identity import identity, payload_token
        have = set(found.columns)
        for c in columns:
            if f"k_{c}" in have:
                found = found.join(tables[c], f"k_{c}")
        both = {"identity": identity(), "token": payload_token()}
        kept = [c for c in found.columns if c in STATS or c == "_n"]
        return found.select(*[both.get(c, F.col(c)).alias(c) for c in wanted], *kept)

    return LateSnapshots(facts, keys, look_up)


@pytest.mark.parametrize("seed", [1, 2])
def test_late_lookup_equals_early(spark, categories, seed):
    snaps = odd_snapshots(spark, seed).cache()
    want = answers(snaps, categories)
    assert answers(late_of(snaps), categories) == want
    assert answers(reduced_snapshots(snaps), categories) == want
    assert answers(reduced_snapshots(late_of(snaps)), categories) == want


def test_one_pass_equals_the_single_programs(spark, snapshots, categories):
    for snaps in (odd_snapshots(spark, 3), snapshots, late_of(odd_snapshots(spark, 4)), odd_snapshots(spark).limit(0)):
        parts = P.programs_of(P.best_snapshots(snaps), categories, "IN")
        assert rows(parts["channelCount"]) == rows(P.channel_video_count(snaps))
        assert rows(parts["channelStats"]) == rows(P.channel_totals(snaps))
        assert rows(parts["categoryStats"]) == rows(P.category_totals(snaps, categories, "IN"))
        assert rows(parts["videoStats"]) == rows(P.video_table(snaps))
        assert rows(parts["correlation"]) == rows(P.stat_correlation(snaps))


def test_a_constant_statistic_has_no_correlation(spark):
    data = [("IN", f"v{k}", "T", "A", "x", None, k + 1, 7, k * k, -k) for k in range(5)]
    for n in (5, 1, 0):
        got = {(r.stat_a, r.stat_b): r.r for r in P.stat_correlation(spark.createDataFrame(data, SNAPSHOT_SCHEMA).limit(n), digits=6).collect()}
        assert len(got) == 6 and got["views", "likes"] is None and got["views", "comments"] == (-1.0 if n > 1 else None)


def test_required_fields_are_kept_per_payload(spark):
    """The most viewed row lacks likes: the count sees it, the statistics do not."""
    data = [("IN", "v", "T", "A", "x", None, 9, None, 1, 1), ("IN", "v", "T", "B", "x", None, 5, 1, 1, 1), ("IN", "v", "T", "C", "10", 10, 2, 1, 1, 1)]
    best = P.best_snapshots(spark.createDataFrame(data, SNAPSHOT_SCHEMA)).first()
    assert (best.counted.payload, best.channel.payload, best.category.payload, best.video.views) == ("A", "B", 10, 5)


def test_run_all_reads_the_snapshots_once(spark, tmp_path, monkeypatch):
    """Every report equals the single program's; after the stage is written the input is gone."""
    csv_dir, json_dir = write_fixture(str(tmp_path / "in"))
    out, single = str(tmp_path / "all"), str(tmp_path / "single")
    for program, more in (("channel-videos", []), ("channel-stats", []), ("category-stats", ["--dictionaries", json_dir, "--region", "IN"]),
                          ("video-stats", []), ("correlation", [])):
        cli.run(cli.parse_args([program, csv_dir, f"{single}/{program}", *more]))
    real = P.write_bucketed_stage

    def then_without_input(*args, **kw):
        stage = real(*args, **kw)
        shutil.rmtree(csv_dir)
        return stage

    monkeypatch.setattr(P, "write_bucketed_stage", then_without_input)
    written = cli.run(cli.parse_args(["all", csv_dir, out, "--dictionaries", json_dir, "--region", "IN", "--buckets", "3"]))
    assert lines(written["channelCount"]) == lines(f"{single}/channel-videos/viewStats")
    correlations = lambda path: {tuple(x.split("\t")[:2]): round(float(x.split("\t")[2]), 9) for x in lines(path)}
    assert correlations(written["correlation"]) == correlations(f"{single}/correlation/correlation")
    for name, program in (("channelStats", "channel-stats"), ("categoryStats", "category-stats"), ("videoStats", "video-stats")):
        for report in ("viewStats", "likeStats", "dislikesStats", "commentStats"):
            assert lines(written[f"{name}/{report}"]) == lines(f"{single}/{program}/{report}") != []


def test_bucketed_stage_answers_in_a_later_session(spark, categories, tmp_path):
    snaps = odd_snapshots(spark, 5).cache()
    path = str(tmp_path / "it's a stage")
    write_bucketed_stage(reduced_snapshots(snaps), path, "identity", 4)
    assert len({f.split("_")[-1] for f in os.listdir(path) if f.startswith("part-")}) <= 4
    stage = read_bucketed_stage(spark.newSession(), path)
    assert stage.count() < snaps.count()
    assert answers(read_bucketed_stage(spark, path), categories) == answers(snaps, categories)
    write_bucketed_stage(reduced_snapshots(odd_snapshots(spark, 6)), path, "identity", 2)   # overwritten, other buckets
    assert answers(read_bucketed_stage(spark, path), categories) == answers(odd_snapshots(spark, 6), categories)


def test_ingest_bucketed_then_programs(spark, fixture_dirs, tmp_path):
    csv_dir, json_dir = fixture_dirs
    out = str(tmp_path)
    stage = cli.run(cli.parse_args(["ingest", csv_dir, out, "--bucketed", "--buckets", "2"]))["snapshots"]
    for program, more, report in (("channel-stats", [], "viewStats"), ("channel-rows", [], "channelRows"), ("video-stats", [], "likeStats"),
                                  ("category-views", ["--dictionaries", json_dir], "catViews")):
        a = cli.run(cli.parse_args([program, stage, f"{out}/s-{program}", "--input-format", "stage", *more]))
        b = cli.run(cli.parse_args([program, csv_dir, f"{out}/c-{program}", *more]))
        assert lines(a[report]) == lines(b[report]) != []


def test_empty_stage_and_folder_without_stage(spark, categories, tmp_path):
    empty = odd_snapshots(spark).limit(0)
    stage = write_bucketed_stage(reduced_snapshots(empty), str(tmp_path / "s"), "identity", 2)
    assert answers(stage, categories) == answers(empty, categories)
    os.makedirs(tmp_path / "none" / "_bucketing")
    with pytest.raises(Exception, match="no bucketed stage"):
        read_bucketed_stage(spark, str(tmp_path / "none"))
