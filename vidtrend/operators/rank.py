"""Rankings, top-k and report projection.

A full ranking is a global ``orderBy`` (range-partitioned sort, every
executor sorts its own range).  The names follow the statistic in the sort
key, so equal statistics are ordered by name and the range partitioner can
split a large group of equal values over several tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from vidtrend.schema import STATS


def report_columns(stat: str, names: Sequence[str], stats: Sequence[str] = STATS,
                   extra: Sequence[str] = ()) -> list[str]:
    """The ranked statistic first, then the names, then the other
    statistics in input-column order, then ``extra``."""
    if stat not in stats:
        raise ValueError(f"unknown statistic {stat!r}; expected one of {tuple(stats)}")
    return [stat, *names, *[s for s in stats if s != stat], *extra]


def ranking_order(stat: str, names: Sequence[str]) -> list[Column]:
    return [F.col(stat).desc(), *[F.col(n).asc() for n in names]]


def rank_report(df: DataFrame, stat: str, names: Sequence[str], stats: Sequence[str] = STATS,
                extra: Sequence[str] = ()) -> DataFrame:
    """The whole report ordered by ``stat`` descending, then names."""
    cols = report_columns(stat, names, stats, extra)
    return df.select(*cols).orderBy(*ranking_order(stat, [*names, *extra]))


def top_k(df: DataFrame, stat: str, k: int, names: Sequence[str]) -> DataFrame:
    """The first ``k`` rows of a ranking (each task keeps its own best k;
    one final merge sees only k rows per task).  ``k`` is a report's length: it
    must be small enough for one task."""
    if k < 1:
        raise ValueError("k must be positive")
    return df.orderBy(*ranking_order(stat, names)).limit(k)


def top_k_with_ties(df: DataFrame, stat: str, k: int, names: Sequence[str] = (),
                    rank_col: str = "rank") -> DataFrame:
    """Every row whose ``rank()`` by ``stat`` descending is <= ``k``.

    No window runs over the whole input.  The first ``k`` rows (a take-ordered
    head, k rows per task) are ranked by a window over those k rows; every row
    ranked above the k-th value is among them with its final rank.  One scalar
    subquery over the head gives the k-th value and the rank all rows equal to
    it share, and those rows - however many - are filtered from the input in
    parallel."""
    if k < 1:
        raise ValueError("k must be positive")
    head = (df.orderBy(*ranking_order(stat, names)).limit(k)
            .withColumn(rank_col, F.rank().over(Window.orderBy(F.col(stat).desc()))))
    cut = head.agg(F.struct(F.min(stat).alias("kth"), F.max(rank_col).alias("tie_rank"))).scalar()
    above = head.where(F.col(stat) > cut.getField("kth"))
    tied = df.where(F.col(stat) == cut.getField("kth")).withColumn(rank_col, cut.getField("tie_rank"))
    return above.unionByName(tied).orderBy(F.col(rank_col), *ranking_order(stat, names))
