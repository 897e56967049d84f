"""vidtrend: statistics over daily snapshots of trending videos on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark's
own operators; see README.md for the operator map.
"""

from vidtrend.session import build_session
from vidtrend.sources import read_categories, read_report, read_snapshots, write_report
from vidtrend.plans import programs

__all__ = [
    "build_session",
    "read_categories", "read_report", "read_snapshots", "write_report",
    "programs",
]
