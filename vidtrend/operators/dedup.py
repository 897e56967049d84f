"""One snapshot per video.

The snapshots of a video are reduced to the one with the most views.  Ties
are broken deterministically (D7) by comparing the remaining statistics and
then the payload text, all as one struct: ``max(struct(views, likes, ...,
payload))``.  That is a partial + final aggregation: every map task reduces
its own rows of a video to one before the shuffle, so a video (or a title
shared by many error-coded rows) with a huge number of snapshots cannot
overload one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vidtrend.operators.clean import REQUIRE_STATS, REQUIRE_STATS_AND_CATEGORY, REQUIRE_VIEWS
from vidtrend.functions.identity import report_id, report_title
from vidtrend.schema import STATS


def best_snapshot(df: DataFrame, payload: Sequence[str], key: str = "identity",
                  ranked_by: Sequence[str] = STATS, no_winner: str = "drop",
                  blank: Sequence[str] = ()) -> DataFrame:
    """Per ``key`` keep the row with the highest ``ranked_by`` (then payload).

    ``no_winner`` (D6) decides about a video whose best views are <= 0, which
    has no winning snapshot: ``"drop"`` removes it, ``"blank"`` keeps it with
    the ``blank`` payload columns set to '' (the video-count program counts
    such videos under an empty channel name), ``"keep"`` keeps it unchanged.
    """
    order = list(ranked_by) + [c for c in payload if c not in ranked_by]
    best = (df.groupBy(key)
            .agg(F.max(F.struct(*[F.col(c) for c in order])).alias("_best"))
            .select(key, *[F.col(f"_best.{c}").alias(c) for c in order]))
    return _winners(best, ranked_by[0], no_winner, blank)


def _winners(best: DataFrame, stat: str, no_winner: str, blank: Sequence[str]) -> DataFrame:
    """The D6 rule of ``best_snapshot``."""
    has_winner = F.col(stat) > 0
    if no_winner == "drop":
        return best.where(has_winner)
    if no_winner == "blank":
        return best.withColumns({c: F.when(has_winner, F.col(c)).otherwise(F.lit("")) for c in blank})
    if no_winner == "keep":
        return best
    raise ValueError(f"unknown no_winner rule {no_winner!r}")


# The payload of each of the best snapshots that ``best_of_all`` takes, and the
# fields that must parse for it.
PAYLOADS = {
    "video": ("token", REQUIRE_STATS),
    "channel": ("channel", REQUIRE_STATS),
    "category": ("category_id", REQUIRE_STATS_AND_CATEGORY),
    "counted": ("channel", REQUIRE_VIEWS),
}


def best_of_all(df: DataFrame) -> DataFrame:
    """D1-D4 in one aggregation: ``(identity, video, channel, category, counted)``,
    each the struct of the best snapshot with that payload, null where no row of
    the video has the fields it needs.  Every row needs the views (P4)."""
    def best(payload: str, required: Sequence[str]) -> Column:
        valid = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])
        return F.max(F.when(valid, F.struct(*STATS, F.col(payload).alias("payload"))))

    return df.groupBy("identity").agg(*[best(*of).alias(name) for name, of in PAYLOADS.items()])


def one_of(best: DataFrame, name: str) -> DataFrame:
    """One of the best snapshots of ``best_of_all``, as ``best_snapshot`` gives it (D6 applied)."""
    payload = PAYLOADS[name][0]
    rows = (best.where(F.col(name).isNotNull())
            .select("identity", *[F.col(f"{name}.{s}").alias(s) for s in STATS], F.col(f"{name}.payload").alias(payload)))
    return _winners(rows, STATS[0], "blank" if name == "counted" else "drop", [payload])


def best_video(df: DataFrame) -> DataFrame:
    """``(video_id, title, views, likes, dislikes, comments)`` per video;
    title-keyed videos print ``N/A`` as id (P6).  Needs ``with_identity``."""
    return printed(best_snapshot(df, payload=["token"]))


def printed(best: DataFrame) -> DataFrame:
    """Best snapshots with the token payload, as reports print them."""
    return best.select(report_id().alias("video_id"), report_title().alias("title"), *STATS)


def best_channel_snapshot(df: DataFrame) -> DataFrame:
    """``(identity, channel, views, likes, dislikes, comments)``."""
    return best_snapshot(df, payload=["channel"])


def best_category_snapshot(df: DataFrame) -> DataFrame:
    """D3: ``(identity, category_id, views, likes, dislikes, comments)``."""
    return best_snapshot(df, payload=["category_id"])


def channel_of_video(df: DataFrame) -> DataFrame:
    """D4 + D6: ``(identity, channel)``; a video without a positive view count
    is kept under the channel ''.  Only the views must parse; equal views go on
    to the other statistics (one that does not parse comes last) as in D2, so
    both programs name the same channel."""
    return best_snapshot(df, payload=["channel"], no_winner="blank",
                         blank=["channel"]).select("identity", "channel")


def max_views(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Highest views per ``keys``, never below 0 (zero-view keys stay)."""
    return df.groupBy(*keys).agg(F.greatest(F.max("views"), F.lit(0).cast("bigint")).alias("views"))
