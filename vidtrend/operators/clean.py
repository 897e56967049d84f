"""Row validity per program (P2, P4) and the video identity (P5)."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from vidtrend.functions.identity import identity, payload_token
from vidtrend.schema import HEADER_ID

# Which parsed fields each program needs (P4).  A row missing one of them is
# dropped by that program only.
REQUIRE_NOTHING: tuple[str, ...] = ()
REQUIRE_VIEWS = ("views",)
REQUIRE_STATS = ("views", "likes", "dislikes", "comments")
REQUIRE_STATS_AND_CATEGORY = REQUIRE_STATS + ("category_id",)


def valid_rows(snapshots: DataFrame, required: Iterable[str] = REQUIRE_STATS,
               drop_header: bool = True) -> DataFrame:
    """Keep rows whose ``required`` fields parsed (P4) and, unless
    ``drop_header`` is off, that are not a header line anywhere in a file (P2)."""
    conds = [F.col(c).isNotNull() for c in required]
    if drop_header:
        conds.append(F.col("video_id") != F.lit(HEADER_ID))
    if not conds:
        return snapshots
    return snapshots.where(reduce(lambda a, b: a & b, conds))


def with_identity(snapshots: DataFrame) -> DataFrame:
    """Add ``identity`` (grouping key of a video) and ``token`` (the text that
    travels with it: error code or title), P5.  A frame that has them keeps its
    own: a stage bucketed by identity is aggregated as it lies."""
    if {"identity", "token"} <= set(snapshots.columns):
        return snapshots
    return snapshots.withColumns({"identity": identity(), "token": payload_token()})
