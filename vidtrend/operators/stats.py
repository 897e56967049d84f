"""Pairwise Pearson correlation of the statistics, one pass."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, functions as F

from vidtrend.schema import STATS


def stat_correlations(df: DataFrame, stats: Sequence[str] = STATS,
                      digits: int | None = None) -> DataFrame:
    """Long format ``(stat_a, stat_b, r)``, one row per pair in input-column
    order.  All pairs are computed by one partial + final aggregation.  A statistic
    that is the same everywhere has no correlation: null (``corr`` would divide by zero)."""
    pairs = list(combinations(stats, 2))
    aggs = []
    for i, (a, b) in enumerate(pairs):
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        aggs.append((F.round(r, digits) if digits is not None else r).alias(f"r{i}"))
    wide = df.agg(*aggs)
    entries = ", ".join(f"'{a}', '{b}', r{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {entries}) as (stat_a, stat_b, r)")
