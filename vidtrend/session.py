"""Session settings the operators are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Runtime re-planning: coalesce small shuffle partitions, split skewed ones,
# and turn a sort-merge join into a broadcast join when one side turns out small.
ADAPTIVE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "vidtrend", extra: dict | None = None) -> SparkSession:
    """Create (or return) a session with the adaptive settings above.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: they come from
    the submit configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in ADAPTIVE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
