"""The user-visible queries (Q1-Q9), each a lazy plan over a snapshots frame
(``sources.read_snapshots``, or any frame of ``SNAPSHOT_SCHEMA``), or over
``LateSnapshots`` (names in dimension tables), and, for the category queries, a dictionary frame (``sources.read_categories``).

Typical plans (see README): scan -> filter -> partial aggregate -> hash
shuffle -> final aggregate [-> partial roll-up -> shuffle -> final] ->
lookup in the dictionary -> range shuffle -> sort.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, functions as F

from vidtrend.functions.text import parse_int
from vidtrend.operators.clean import (
    REQUIRE_NOTHING, REQUIRE_STATS, REQUIRE_STATS_AND_CATEGORY, REQUIRE_VIEWS, valid_rows,
)
from vidtrend.operators.dedup import (
    best_category_snapshot, best_channel_snapshot, best_of_all, best_video, channel_of_video, max_views, one_of, printed,
)
from vidtrend.operators.late import LateSnapshots, Snapshots, video_rows
from vidtrend.operators.lookup import label_by_region, label_one_region
from vidtrend.operators.rank import rank_report, report_columns, top_k, top_k_with_ties
from vidtrend.operators.rollup import count_by, totals_by, views_by
from vidtrend.operators.stats import stat_correlations
from vidtrend.schema import (
    CATEGORY_VIEWS_REPORT, COUNT_HEADER, MISSING_ID, REPORT_NAMES, STAGE_1, STAGE_2, STATS,
)
from vidtrend.sources.sinks import write_bucketed_stage, write_report, write_stage



# --- Q1 / Q2: channels by number of trending rows / videos ----------------

def channel_row_count(snapshots: Snapshots) -> DataFrame:
    """Q1 (A1): ``(channel, n)`` - every 16-field row counts, header lines and
    rows with unparsable numbers included; no de-duplication."""
    if isinstance(snapshots, LateSnapshots):
        return snapshots.count("channel")
    rows = valid_rows(snapshots, REQUIRE_NOTHING, drop_header=False)
    if "n_rows" in rows.columns:   # a reduced stage
        return rows.groupBy("channel").agg(F.sum("n_rows").alias("n"))
    return count_by(rows, "channel", "n")


def channel_video_count(snapshots: Snapshots) -> DataFrame:
    """Q2 stages 1-2 (D4, D6, A2): ``(channel, n)`` distinct videos per channel
    of each video's best snapshot; videos without a positive view count are
    counted under ''."""
    videos = channel_of_video(video_rows(snapshots, REQUIRE_VIEWS, ["channel"]))
    return count_by(videos, "channel", "n")


def channel_video_ranking(snapshots: Snapshots) -> DataFrame:
    """Q2 (O5): ``(n, channel)`` ranked by ``n``."""
    return rank_report(channel_video_count(snapshots), "n", ["channel"], stats=["n"])


def top_channels_by_video_count(snapshots: Snapshots, k: int = 5) -> DataFrame:
    """Q2 top-k (O6): ``(n, channel, rank)`` with whole tie groups at the cut."""
    counts = channel_video_count(snapshots)
    return top_k_with_ties(counts, "n", k, ["channel"]).select("n", "channel", "rank")


# --- Q3 / Q4: channel statistics -------------------------------------------

def channel_totals(snapshots: Snapshots) -> DataFrame:
    """Q3/Q4 stages 1-2 (D2, D6, A3): ``(channel, views, likes, dislikes, comments)``."""
    best = best_channel_snapshot(video_rows(snapshots, REQUIRE_STATS, ["channel"]))
    return totals_by(best, "channel")


def channel_stats(snapshots: Snapshots, stat: str = "views") -> DataFrame:
    """Q4a-d (Q3 = by views): channels ranked by one statistic (P8 order)."""
    return rank_report(channel_totals(snapshots), stat, ["channel"])


def most_viewed_channels(snapshots: Snapshots) -> DataFrame:
    """Q3: ``(views, channel, likes, dislikes, comments)`` by views."""
    return channel_stats(snapshots, "views")


def top_viewed_channels(snapshots: Snapshots, k: int = 5) -> DataFrame:
    """Q9 (O7): the head of Q3."""
    return head_of(channel_totals(snapshots), "views", ["channel"], k)


# --- Q5: category statistics with one region's dictionary ------------------

def category_totals(snapshots: Snapshots, categories: DataFrame, region: str) -> DataFrame:
    """Q5 stages 1-2 (D3, D6, A4, J2): ``(category_id, label, views, likes,
    dislikes, comments)``.  Ids are summed first and labelled after, so two ids
    with one title stay two rows; the (tiny) totals are what is looked up."""
    best = best_category_snapshot(video_rows(snapshots, REQUIRE_STATS_AND_CATEGORY, ["category_id"]))
    return label_one_region(totals_by(best, "category_id"), categories, region)


def category_stats(snapshots: Snapshots, categories: DataFrame, region: str,
                   stat: str = "views") -> DataFrame:
    """Q5a-d: categories ranked by one statistic; ties by label, then id."""
    return rank_report(category_totals(snapshots, categories, region), stat, ["label"],
                       extra=["category_id"])


# --- Q6: video statistics ----------------------------------------------------

def video_table(snapshots: Snapshots) -> DataFrame:
    """Q6 stage 1 (D1, D6, P6): ``(video_id, title, views, likes, dislikes, comments)``."""
    return best_video(video_rows(snapshots, REQUIRE_STATS, ["token"]))


def title_keyed_videos(snapshots: Snapshots) -> DataFrame:
    """The videos whose id was a spreadsheet error code, keyed by title
    and printed with the id ``N/A``."""
    return video_table(snapshots).where(F.col("video_id") == MISSING_ID)


def video_stats(snapshots: Snapshots, stat: str = "views") -> DataFrame:
    """Q6a-d: videos ranked by one statistic."""
    return rank_report(video_table(snapshots), stat, ["video_id", "title"])


# --- Q7: views per category label over all regions ---------------------------

def category_views(snapshots: Snapshots, categories: DataFrame) -> DataFrame:
    """Q7 (D5, J1, A5): ``(label, views)``.  Highest views per (id, title,
    region, category) - zero-view keys stay - summed per region and category;
    each of these few rows is labelled with its own region's dictionary, and
    labels are summed again, so ids with one title merge."""
    return _labelled_views(_category_max_views(snapshots), categories)


def _labelled_views(best: DataFrame, categories: DataFrame) -> DataFrame:
    by_category = best.groupBy("region", "category_raw", "category_id").agg(F.sum("views").cast("bigint").alias("views"))
    return views_by(label_by_region(by_category, categories), "label")


def _category_max_views(snapshots: Snapshots) -> DataFrame:
    """Q7 stage 1 (D5): highest views per (id, title, region, category)."""
    key = ["video_id", "title", "region", "category_raw"]
    rows = snapshots.best(key, REQUIRE_VIEWS) if isinstance(snapshots, LateSnapshots) else snapshots
    best = max_views(valid_rows(rows, REQUIRE_VIEWS, drop_header=False), key)
    return best.withColumn("category_id", parse_int("category_raw"))


# --- Q8: correlation ------------------------------------------------------------

def stat_correlation(snapshots: Snapshots, digits: int | None = None) -> DataFrame:
    """Q8 (C1): ``(stat_a, stat_b, r)`` over the best snapshot of every video."""
    return stat_correlations(video_table(snapshots), STATS, digits)


# --- Q2-Q6 and Q8 from one dedup ------------------------------------------------

def best_snapshots(snapshots: Snapshots) -> DataFrame:
    """D1-D4 of every video in one pass over the snapshots (``dedup.best_of_all``)."""
    return best_of_all(video_rows(snapshots, REQUIRE_VIEWS, ["token", "channel", "category_id"]))


def programs_of(best: DataFrame, categories: DataFrame, region: str) -> dict[str, DataFrame]:
    """The totals behind the reports Q2-Q6 and Q8, from ``best_snapshots``: channel
    counts, channel totals, category totals, videos, correlations."""
    videos = printed(one_of(best, "video"))
    return {
        "channelCount": count_by(one_of(best, "counted"), "channel", "n"),
        "channelStats": totals_by(one_of(best, "channel"), "channel"),
        "categoryStats": label_one_region(totals_by(one_of(best, "category"), "category_id"), categories, region),
        "videoStats": videos,
        "correlation": stat_correlations(videos, STATS),
    }


def run_all(snapshots: Snapshots, categories: DataFrame, region: str, out_prefix: str, fmt: str = "tsv",
            buckets: int | None = None) -> dict[str, str]:
    """Every report of Q2-Q6, Q8 and Q9 from one dedup of the snapshots.

    The best snapshots are written once (``_stages/best``, a row per video) and all
    reports read them, each in a folder of its own.  Returns ``{report: path}``."""
    best = write_bucketed_stage(best_snapshots(snapshots), os.path.join(out_prefix, "_stages", "best"), "identity", buckets)
    parts = programs_of(best, categories, region)
    written: dict[str, str] = {}
    for name, names, extra in (("channelStats", ["channel"], ()), ("categoryStats", ["label"], ("category_id",)),
                               ("videoStats", ["video_id", "title"], ())):
        reports = write_stats_reports(parts[name], os.path.join(out_prefix, name), names, extra, fmt)
        written |= {f"{name}/{report}": path for report, path in reports.items()}
    for name, report, header in (
            ("channelCount", rank_report(parts["channelCount"], "n", ["channel"], stats=["n"]), list(COUNT_HEADER)),
            ("correlation", parts["correlation"].orderBy("stat_a", "stat_b"), None)):
        written[name] = os.path.join(out_prefix, name)
        write_report(report, written[name], fmt=fmt, header=header if fmt == "tsv" else None)
    return written


# --- whole programs: stage + four written rankings (S6, S7) --------------------

def head_of(totals: DataFrame, stat: str, names: list[str], k: int | None = None,
            with_ties: bool = False, extra: tuple[str, ...] = ()) -> DataFrame:
    """Q9: the totals ranked (``k`` None), their first ``k`` rows (O7), or their
    top ``k`` with whole tie groups and a ``rank`` column (O6)."""
    if k is None:
        return rank_report(totals, stat, names, extra=extra)
    rows = totals.select(*report_columns(stat, names, extra=extra))
    if with_ties:
        return top_k_with_ties(rows, stat, k, [*names, *extra])
    return top_k(rows, stat, k, [*names, *extra])


def write_stats_reports(totals: DataFrame, out_prefix: str, names: list[str],
                        extra: tuple[str, ...] = (), fmt: str = "tsv",
                        stage_name: str = STAGE_2, k: int | None = None,
                        with_ties: bool = False) -> dict[str, str]:
    """Write ``totals`` once as a stage and the four rankings read from it
    (optionally only their heads, see ``head_of``).
    Returns ``{report name: path}``."""
    stage = write_stage(totals, os.path.join(out_prefix, "_stages", stage_name))
    written = {stage_name: os.path.join(out_prefix, "_stages", stage_name)}
    if fmt == "tsv":
        # the stage in the original text layout: names, then likes, dislikes,
        # comments, views
        path = os.path.join(out_prefix, stage_name)
        write_report(stage.select(*names, "likes", "dislikes", "comments", "views"), path)
        written[stage_name] = path
    for stat, report in REPORT_NAMES.items():
        path = os.path.join(out_prefix, report)
        # ``extra`` columns only settle ties: they are not part of the files
        ranked = head_of(stage, stat, names, k, with_ties, extra).drop(*extra)
        write_report(ranked, path, fmt=fmt)
        written[report] = path
    return written


def _stats_stage(best: DataFrame, names: list[str], out_prefix: str, fmt: str) -> DataFrame:
    """Keep ``Inter_1``: the best snapshot of every video, names first, then
    likes, dislikes, comments, views."""
    return _keep_stage(best.select(*names, "likes", "dislikes", "comments", "views"), out_prefix, STAGE_1, fmt)


def run_channel_stats(snapshots: Snapshots, out_prefix: str, fmt: str = "tsv",
                      k: int | None = None, with_ties: bool = False, save_stages: bool = False) -> dict[str, str]:
    """Q4 as a program.  ``save_stages`` also keeps ``Inter_1``, one row per video."""
    if not save_stages:
        totals = channel_totals(snapshots)
    else:
        best = best_channel_snapshot(video_rows(snapshots, REQUIRE_STATS, ["channel"]))
        totals = totals_by(_stats_stage(best, ["channel"], out_prefix, fmt), "channel")
    return write_stats_reports(totals, out_prefix, ["channel"], fmt=fmt, k=k, with_ties=with_ties)


def run_viewed_channels(snapshots: Snapshots, out_prefix: str, fmt: str = "tsv", k: int | None = None,
                        with_ties: bool = False, save_stages: bool = False) -> str:
    """Q3 as a program: the ranking by views; ``save_stages`` also keeps
    ``Inter_1`` (one row per video) and ``Inter_2`` (the totals)."""
    if save_stages:
        best = best_channel_snapshot(video_rows(snapshots, REQUIRE_STATS, ["channel"]))
        best = _stats_stage(best, ["channel"], out_prefix, fmt)
        totals = totals_by(best, "channel").select("channel", "likes", "dislikes", "comments", "views")
        totals = _keep_stage(totals, out_prefix, STAGE_2, fmt)
    else:
        totals = channel_totals(snapshots)
    path = os.path.join(out_prefix, REPORT_NAMES["views"])
    write_report(head_of(totals, "views", ["channel"], k, with_ties), path, fmt=fmt)
    return path


def run_category_stats(snapshots: Snapshots, categories: DataFrame, region: str,
                       out_prefix: str, fmt: str = "tsv", k: int | None = None,
                       with_ties: bool = False, save_stages: bool = False) -> dict[str, str]:
    """Q5 as a program.  ``save_stages`` also keeps ``Inter_1`` (category id and
    statistics of every video)."""
    if not save_stages:
        totals = category_totals(snapshots, categories, region)
    else:
        best = best_category_snapshot(video_rows(snapshots, REQUIRE_STATS_AND_CATEGORY, ["category_id"]))
        best = _stats_stage(best, ["category_id"], out_prefix, fmt)
        totals = label_one_region(totals_by(best, "category_id"), categories, region)
    return write_stats_reports(totals, out_prefix, ["label"], extra=("category_id",), fmt=fmt, k=k,
                               with_ties=with_ties)


def run_video_stats(snapshots: Snapshots, out_prefix: str, fmt: str = "tsv",
                    k: int | None = None, with_ties: bool = False) -> dict[str, str]:
    return write_stats_reports(video_table(snapshots), out_prefix, ["video_id", "title"],
                               fmt=fmt, stage_name=STAGE_1, k=k, with_ties=with_ties)


def run_channel_count(snapshots: Snapshots, out_prefix: str, k: int | None = None,
                      fmt: str = "tsv", save_stages: bool = False) -> str:
    """Q2 as a program: the full ranking, or the top ``k`` with ties, with a
    header line (P10).  ``save_stages`` also keeps ``Inter_1`` (channel, 1 per
    video) and ``Inter_2`` (channel, n).  Returns the ranking's path."""
    if save_stages:
        videos = channel_of_video(video_rows(snapshots, REQUIRE_VIEWS, ["channel"]))
        videos = _keep_stage(videos.select("channel", F.lit(1).alias("one")), out_prefix, STAGE_1, fmt)
        counts = _keep_stage(count_by(videos, "channel", "n"), out_prefix, STAGE_2, fmt)
    else:
        counts = channel_video_count(snapshots)
    path = os.path.join(out_prefix, REPORT_NAMES["views"])
    if k is None:
        report, header = rank_report(counts, "n", ["channel"], stats=["n"]), list(COUNT_HEADER)
    else:
        report = top_k_with_ties(counts, "n", k, ["channel"]).select("n", "channel", "rank")
        header = [*COUNT_HEADER, "Rank"]
    write_report(report, path, fmt=fmt, header=header if fmt == "tsv" else None)
    return path


def run_category_views(snapshots: Snapshots, categories: DataFrame, out_prefix: str,
                       fmt: str = "tsv", save_stages: bool = False) -> str:
    """Q7 as a program: ``catViews`` (label, views) in label order.
    ``save_stages`` also keeps ``Inter_1`` (region, category, highest views of
    each (id, title, region, category)).  Returns the report's path."""
    best = _category_max_views(snapshots)
    if save_stages:
        best = write_stage(best, os.path.join(out_prefix, "_stages", STAGE_1))
        if fmt == "tsv":
            write_report(best.select("region", "category_raw", "views"), os.path.join(out_prefix, STAGE_1))
    path = os.path.join(out_prefix, CATEGORY_VIEWS_REPORT)
    write_report(_labelled_views(best, categories).orderBy("label"), path, fmt=fmt)
    return path


def _keep_stage(df: DataFrame, out_prefix: str, name: str, fmt: str) -> DataFrame:
    """Write ``df`` as a parquet stage (and as TSV for a TSV run) and continue
    from the written copy."""
    stage = write_stage(df, os.path.join(out_prefix, "_stages", name))
    if fmt == "tsv":
        write_report(stage, os.path.join(out_prefix, name))
    return stage
