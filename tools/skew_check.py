"""Skew check on the benchmark tables: best snapshot per key where every key
holds about a third of all rows (the return flag, last character of the
model's title).  Compares the records each plan writes to its shuffle,
read from Spark's event log in a scratch folder.  (Spark also combines a
``row_number() = 1`` filter map-side, so both plans are skew-safe; the
argmax is the one that needs no window and no sort of the group.)

    python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window, functions as F  # noqa: E402

from vidtrend.operators.dedup import best_snapshot  # noqa: E402
from vidtrend.plans import model  # noqa: E402
from vidtrend.session import build_session  # noqa: E402


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    logs = tempfile.mkdtemp(prefix="vidtrend-eventlog-")
    spark = build_session("local[8]", 8, extra={
        "spark.eventLog.enabled": "true", "spark.eventLog.dir": logs,
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    snaps = model.snapshots(spark, sf_dir).withColumn("hot_key", F.substring("title", -1, 1))
    order = ["views", "likes", "dislikes", "comments", "channel"]
    plans = {
        "map-side argmax": lambda: best_snapshot(snaps, payload=["channel"], key="hot_key", no_winner="keep"),
        "row_number window": lambda: snaps.withColumn(
            "rn", F.row_number().over(Window.partitionBy("hot_key").orderBy(*[F.col(c).desc() for c in order])))
            .where("rn = 1").select("hot_key", *order),
    }
    results = {}
    for name, build in plans.items():
        spark.sparkContext.setJobGroup("warm-up", "warm-up")
        build().collect()  # warm-up run, not counted
        spark.sparkContext.setJobGroup(name, name)
        t0 = time.perf_counter()
        rows = sorted(map(tuple, build().collect()))
        results[name] = (rows, round(time.perf_counter() - t0, 2))
    spark.stop()
    written = {}
    path = [p for p in glob.glob(os.path.join(logs, "**"), recursive=True) if os.path.isfile(p)][0]
    group = None
    job_group = {}
    for line in open(path):
        e = json.loads(line)
        if e["Event"] == "SparkListenerJobStart":
            group = e.get("Properties", {}).get("spark.jobGroup.id")
            for sid in e["Stage IDs"]:
                job_group[sid] = group
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            g = job_group.get(e["Stage ID"])
            w = e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Records Written"]
            written[g] = written.get(g, 0) + w
    (a_rows, a_t), (b_rows, b_t) = results.values()
    assert a_rows == b_rows, "both plans must pick the same rows"
    for name, (rows, secs) in results.items():
        print(f"{name:20s} keys={len(rows)} shuffle_records={written.get(name, 0):>8d} seconds={secs}")


if __name__ == "__main__":
    main(sys.argv)
