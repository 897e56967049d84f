"""Late lookup: snapshots whose names stand in dimension tables.

A fact holds keys and statistics; ids, titles, channels, regions and categories
are looked up.  Joining first would shuffle every fact once per dimension too
large to send around.  Every program keeps, per video, the snapshot with the
highest (views, likes, dislikes, comments, payload), and the payload is a
function of the keys.  So the facts are first reduced per combination of keys
to their highest statistics, a partial and final aggregation with one exchange
of the facts, and only the reduced rows meet the dimensions.  The program's own
dedup by identity then runs unchanged on the looked-up rows: the highest of the
highest is the highest of all.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vidtrend.operators.clean import valid_rows, with_identity
from vidtrend.schema import SNAPSHOT_COLUMNS, STATS


@dataclass(frozen=True)
class LateSnapshots:
    """``keys``: for each snapshot column (also ``identity`` and ``token``), the
    fact columns that determine it.  ``look_up(rows, columns)`` adds the columns
    to rows that hold those keys.  A statistic that is itself looked up stands in
    ``keys``; the others are fact columns."""

    facts: DataFrame
    keys: Mapping[str, tuple[str, ...]]
    look_up: Callable[[DataFrame, Sequence[str]], DataFrame]

    def _keys_of(self, columns: Iterable[str]) -> list[str]:
        return list(dict.fromkeys(k for c in columns for k in self.keys[c]))

    def best(self, columns: Sequence[str], required: Iterable[str]) -> DataFrame:
        """``columns`` and the statistics: per combination of their keys the
        highest statistics of the facts in which the ``required`` ones parse.
        Facts with all statistics and others are kept apart, for programs that
        need more of them later."""
        late = [s for s in STATS if s in self.keys]
        own = [s for s in STATS if s not in self.keys]
        wanted = [*columns, *late]
        facts = valid_rows(self.facts, [c for c in required if c in own], drop_header=False)
        apart = [] if set(own) <= set(required) else [complete(own).alias("_complete")]
        reduced = (facts.groupBy(*self._keys_of(wanted), *apart).agg(F.max(F.struct(*own)).alias("_best"))
                   .select(*self._keys_of(wanted), *[F.col(f"_best.{s}").alias(s) for s in own]))
        return self.look_up(reduced, wanted).select(*columns, *STATS)

    def count(self, column: str) -> DataFrame:
        """``(column, n)``: facts per value, counted per key before the lookup."""
        counts = self.facts.groupBy(*self._keys_of([column])).agg(F.count(F.lit(1)).alias("_n"))
        return (self.look_up(counts, [column]).groupBy(column).agg(F.sum("_n").alias("n")))

    def frame(self, columns: Sequence[str]) -> DataFrame:
        """Every fact's ``columns`` looked up (no reduction)."""
        return self.look_up(self.facts, columns)


Snapshots = DataFrame | LateSnapshots


def complete(stats: Sequence[str] = STATS) -> Column:
    return reduce(lambda a, b: a & b, [F.col(s).isNotNull() for s in stats])


def reduced_snapshots(snapshots: Snapshots) -> DataFrame:
    """Snapshots merged where no program tells them apart (S7): one row per
    region, id, title, channel, category, and whether all statistics parse, with
    the highest statistics, the number of rows merged (``n_rows``) and the video's
    ``identity`` and ``token``.  Every program gives the same result over it: best
    snapshots and highest views are those of the merged rows, and the row count
    (Q1) adds ``n_rows`` up.  Headers and rows without numbers are kept."""
    names = [c for c in SNAPSHOT_COLUMNS if c not in STATS]
    rows = snapshots.frame(names) if isinstance(snapshots, LateSnapshots) else snapshots
    best = (rows.groupBy(*names, complete().alias("complete"))
            .agg(F.max(F.struct(*STATS)).alias("_best"), F.count(F.lit(1)).alias("n_rows"))
            .select(*names, *[F.col(f"_best.{s}").alias(s) for s in STATS], "n_rows"))
    return with_identity(best)


def video_rows(snapshots: Snapshots, required: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """Rows that a dedup by ``identity`` takes: valid snapshots (P2, P4) with
    identity, ``payload`` and statistics."""
    if isinstance(snapshots, LateSnapshots):
        rows = snapshots.best(["video_id", "identity", *payload], required)
        return valid_rows(rows, required)
    return with_identity(valid_rows(snapshots, required))
