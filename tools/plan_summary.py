"""Summarise the physical plan of every registered query of the engine: hash / range /
single-partition shuffles, broadcasts, aggregate kinds and windows.

    python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from vidtrend.plans import catalog  # noqa: E402
from vidtrend.session import build_session  # noqa: E402

PATTERNS = {
    "hash shuffles": r"Exchange hashpartitioning",
    "range shuffles": r"Exchange rangepartitioning",
    "single-partition": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "partial aggs": r"(HashAggregate\(keys|SortAggregate\(key)=\[[^\]]*\], functions=\[partial_",
    "sort aggs": r"SortAggregate\(",
    "windows": r"\bWindow \[",
    "subqueries": r"Subquery subquery",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|---" * (len(PATTERNS) + 1) + "|")
    for name, fn in catalog.queries().items():
        text = fn(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        counts = [len(re.findall(p, text)) for p in PATTERNS.values()]
        print(f"| {name} | " + " | ".join(str(c) for c in counts) + " |")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
