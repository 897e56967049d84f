"""DataFrame -> DataFrame operators of the inventory (P, D, A, J, O, C)."""

from vidtrend.operators.clean import (
    REQUIRE_NOTHING, REQUIRE_STATS, REQUIRE_STATS_AND_CATEGORY, REQUIRE_VIEWS,
    valid_rows, with_identity,
)
from vidtrend.operators.dedup import (
    best_category_snapshot, best_channel_snapshot, best_of_all, best_snapshot, best_video,
    channel_of_video, max_views, one_of,
)
from vidtrend.operators.late import LateSnapshots, reduced_snapshots
from vidtrend.operators.lookup import label_by_region, label_one_region
from vidtrend.operators.rank import (
    rank_report, report_columns, top_k, top_k_with_ties,
)
from vidtrend.operators.rollup import count_by, totals_by, views_by
from vidtrend.operators.stats import stat_correlations

__all__ = [
    "REQUIRE_NOTHING", "REQUIRE_STATS", "REQUIRE_STATS_AND_CATEGORY", "REQUIRE_VIEWS",
    "valid_rows", "with_identity",
    "best_category_snapshot", "best_channel_snapshot", "best_snapshot", "best_video",
    "channel_of_video", "max_views", "best_of_all", "one_of", "LateSnapshots", "reduced_snapshots",
    "label_by_region", "label_one_region",
    "rank_report", "report_columns", "top_k", "top_k_with_ties",
    "count_by", "totals_by", "views_by", "stat_correlations",
]
