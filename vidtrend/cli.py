"""Command-line programs: one sub-command per original program.

    python -m vidtrend <program> INPUT OUTPUT [options]            (local)
    zip -r vidtrend.zip vidtrend                                   (cluster)
    spark-submit --py-files vidtrend.zip vidtrend/cli.py <program> INPUT OUTPUT [options]

INPUT is a snapshot CSV file, a folder of regional files or a glob; OUTPUT
is a folder prefix under which the reports (TSV by default) are written.
"""

from __future__ import annotations

import argparse
import os
import sys

from vidtrend.operators.late import reduced_snapshots
from vidtrend.operators.stats import stat_correlations
from vidtrend.plans import programs as P
from vidtrend.session import build_session
from vidtrend.schema import CATEGORY_VIEWS_REPORT, REPORT_NAMES, SNAPSHOT_COLUMNS, SNAPSHOT_SCHEMA
from vidtrend.sources import (
    read_bucketed_stage, read_categories, read_snapshots, write_bucketed_stage, write_report, write_stage,
)

PROGRAMS = ("ingest", "channel-rows", "channel-videos", "viewed-channels", "channel-stats",
            "category-stats", "video-stats", "category-views", "correlation", "all")


def parse_args(argv: list[str]) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="vidtrend", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("program", choices=PROGRAMS)
    ap.add_argument("input", help="snapshot CSV file, folder or glob")
    ap.add_argument("output", help="output folder prefix")
    ap.add_argument("--region", help="two-letter region of the dictionary (category-stats)")
    ap.add_argument("--dictionaries", help="folder of <REGION>_category_id.json files")
    ap.add_argument("--top", type=int, help="keep only the first K rows of each ranking "
                    "(channel-videos: always with whole tie groups)")
    ap.add_argument("--with-ties", action="store_true",
                    help="with --top: keep whole tie groups at the cut and add a rank column")
    ap.add_argument("--encoding", default="UTF-8", help="input charset (UTF-8, ISO-8859-1, US-ASCII, UTF-16, UTF-16LE, UTF-16BE)")
    ap.add_argument("--regions", help="INPUT is a folder of regional files: read only these, e.g. IN,US")
    ap.add_argument("--escape", default="backslash", choices=("backslash", "double"),
                    help="backslash: \\\" is a quote and \\\\ a backslash; double: backslashes are text")
    ap.add_argument("--input-format", default="csv", choices=("csv", "parquet", "stage"),
                    help="parquet: INPUT is the output of the ingest program; stage: of ingest --bucketed")
    ap.add_argument("--bucketed", action="store_true",
                    help="ingest: merge the snapshots no program tells apart and keep them bucketed by video")
    ap.add_argument("--buckets", type=int, help="number of buckets (default: spark.sql.shuffle.partitions)")
    ap.add_argument("--format", default="tsv", choices=("tsv", "parquet"))
    ap.add_argument("--save-stages", action="store_true",
                    help="also keep the intermediate stages")
    ap.add_argument("--master", help="Spark master; leave unset under spark-submit")
    args = ap.parse_args(argv)
    if args.program in ("category-stats", "category-views", "all") and not args.dictionaries:
        ap.error(f"{args.program} needs --dictionaries")
    if args.program in ("category-stats", "all") and (not args.region or len(args.region) != 2):
        ap.error(f"{args.program} needs --region with a two-letter code")
    return args


def run(args: argparse.Namespace) -> dict[str, str]:
    spark = build_session(args.master)
    if args.input_format == "parquet":
        # declared schema: the region partition folders stay text
        snaps = spark.read.schema(SNAPSHOT_SCHEMA).parquet(args.input).select(*SNAPSHOT_COLUMNS)
    elif args.input_format == "stage":
        snaps = read_bucketed_stage(spark, args.input)
    else:
        snaps = read_snapshots(spark, args.input, encoding=args.encoding, escape=args.escape,
                               regions=args.regions.split(",") if args.regions else None)
    out, fmt = args.output, args.format
    if args.program == "ingest":
        # Parse once; every program can then read typed, region-partitioned
        # parquet (column pruning, pushdown, region pruning) instead of CSV.
        path = os.path.join(out, "snapshots")
        if args.bucketed:
            # Programs over it aggregate per video without an exchange.
            write_bucketed_stage(reduced_snapshots(snaps), path, "identity", args.buckets)
            return {"snapshots": path}
        write_stage(snaps, path, partition_by=["region"])
        return {"snapshots": path}
    if args.program == "channel-rows":
        path = os.path.join(out, "channelRows")
        write_report(P.channel_row_count(snaps).orderBy("channel"), path, fmt=fmt)  # key order
        return {"channelRows": path}
    if args.program == "channel-videos":
        return {REPORT_NAMES["views"]: P.run_channel_count(snaps, out, k=args.top, fmt=fmt,
                                                 save_stages=args.save_stages)}
    if args.program == "viewed-channels":
        return {REPORT_NAMES["views"]: P.run_viewed_channels(snaps, out, fmt=fmt, k=args.top, with_ties=args.with_ties,
                                                             save_stages=args.save_stages)}
    if args.program == "channel-stats":
        return P.run_channel_stats(snaps, out, fmt=fmt, k=args.top, with_ties=args.with_ties,
                                   save_stages=args.save_stages)
    if args.program == "video-stats":
        return P.run_video_stats(snaps, out, fmt=fmt, k=args.top, with_ties=args.with_ties)
    if args.program == "correlation":
        path = os.path.join(out, "correlation")
        write_report(stat_correlations(P.video_table(snaps)), path, fmt=fmt)
        return {"correlation": path}
    if args.program == "category-stats":
        cats = read_categories(spark, args.dictionaries, region=args.region)
        return P.run_category_stats(snaps, cats, args.region, out, fmt=fmt, k=args.top,
                                    with_ties=args.with_ties, save_stages=args.save_stages)
    cats = read_categories(spark, args.dictionaries)
    if args.program == "all":
        return P.run_all(snaps, cats, args.region, out, fmt=fmt, buckets=args.buckets)
    return {CATEGORY_VIEWS_REPORT: P.run_category_views(snaps, cats, out, fmt=fmt, save_stages=args.save_stages)}


def main(argv: list[str] | None = None) -> int:
    written = run(parse_args(sys.argv[1:] if argv is None else argv))
    for name, path in written.items():
        print(f"{name}\t{path}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
