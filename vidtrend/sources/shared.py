"""Where jobs keep files that later steps, and other executors, read."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_local_shared: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path for files that later steps read, in the folder that all executors
    share: ``spark.checkpoint.dir`` of the session.  Only a local-mode session
    without that setting (tests) gets a temporary folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_shared:
            _local_shared.append("file://" + tempfile.mkdtemp(prefix="vidtrend-"))
        shared = _local_shared[0]
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
