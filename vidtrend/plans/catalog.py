"""Registered queries over the benchmark tables: ``queries()`` (Spark) and
``oracle_sql()`` (the same results in SQL), keyed alike."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vidtrend.operators.clean import REQUIRE_STATS, REQUIRE_VIEWS, valid_rows, with_identity
from vidtrend.operators.dedup import PAYLOADS, best_channel_snapshot, channel_of_video, one_of
from vidtrend.operators.late import LateSnapshots, reduced_snapshots
from vidtrend.operators.rollup import count_by, totals_by
from vidtrend.plans import model, programs
from vidtrend.plans.oracle import CATEGORY_REGION, ORACLE_SQL
from vidtrend.schema import DICTIONARY_SCHEMA, SNAPSHOT_COLUMNS, STATS
from vidtrend.sources.categories import categories_from_documents
from vidtrend.sources.reports import parse_report_lines, read_report_head
from vidtrend.sources.shared import shared_path
from vidtrend.sources.sinks import to_tsv_lines, write_bucketed_stage, write_report
from vidtrend.sources.snapshots import (
    decode_lines, parse_snapshot_lines, read_snapshots, region_from_file_name, union_snapshots,
)

# Queries that write files to the shared folder and read them back: their files are
# written when the plan is built; all others start no job before they run.
WRITES_FILES = {"bucketed_stage_channels", "bucketed_stage_all_rules", "regional_file_scan", "utf16_titles", "report_head"}

Query = Callable[[SparkSession, str], DataFrame]


def _snaps(spark: SparkSession, sf_dir: str) -> LateSnapshots:
    return model.late_snapshots(spark, sf_dir)


def _with_categories(fn):
    return lambda spark, sf_dir: fn(_snaps(spark, sf_dir), model.categories(spark, sf_dir))


def csv_arity_and_number_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1, P1, P3, P4 on generated CSV lines: only well-formed lines with
    parsable statistics remain, trimmed and typed."""
    lines = model.snapshot_lines(spark, sf_dir)
    rows = valid_rows(parse_snapshot_lines(lines, region="LI"), REQUIRE_STATS)
    return rows.drop("region")


def _dictionaries(spark: SparkSession, sf_dir: str, ids: Column) -> DataFrame:
    """Dictionary documents as on disk, parsed."""
    docs = model.order_dictionaries(spark, sf_dir, ids)
    return categories_from_documents(docs.select("region", F.from_json("json", DICTIONARY_SCHEMA).alias("doc")), items="doc.items")


def category_json_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dictionaries, one per order, written as JSON documents and read back
    (explode, id to int)."""
    return _dictionaries(spark, sf_dir, F.col("l_linenumber"))


def category_json_last_item_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in which ids stand several times: the last item's title
    wins.  Every fifth line has an id that is no number, so its document is known
    by a null id."""
    ids = F.when(F.col("l_linenumber") == 5, F.lit("x")).otherwise((F.col("l_linenumber") % 3).cast("string"))
    return _dictionaries(spark, sf_dir, ids)


def _regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_snapshot_lines(model.regional_lines(spark, sf_dir))


def views_by_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The region comes from the file name; a header line has no views
    and is dropped by that rule alone."""
    rows = valid_rows(_regional(spark, sf_dir), REQUIRE_VIEWS, drop_header=False)
    return rows.groupBy("region").agg(F.count("*").alias("n"), F.sum("views").cast("bigint").alias("views"))


def regional_file_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as regional files, all of them scanned, and those of
    one region only."""
    path, lines = shared_path(spark, "regional"), model.regional_lines(spark, sf_dir)
    for region in ("IN", "US"):
        (lines.where(region_from_file_name() == region).select("value")
         .write.text(f"{path}/{region}videos.csv"))
    scans = (("all", read_snapshots(spark, f"{path}/*")), ("one", read_snapshots(spark, path, regions=["IN"])))
    return reduce(DataFrame.unionByName, [
        valid_rows(rows, REQUIRE_VIEWS, drop_header=False).groupBy("region")
        .agg(F.count("*").alias("n"), F.sum("views").cast("bigint").alias("views")).withColumn("scan", F.lit(scan))
        for scan, rows in scans])


def utf16_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same lines as UTF-16 files of both byte orders, read as lines."""
    path, lines = shared_path(spark, "utf16"), model.regional_lines(spark, sf_dir)
    rows = []
    for charset in ("UTF-16LE", "UTF-16BE"):
        stored = lines.select(F.encode("value", charset).cast("string").alias("value"))
        stored.write.option("encoding", charset).option("lineSep", "\n").text(f"{path}/{charset}")
        encoded = read_snapshots(spark, f"{path}/{charset}", encoding=charset, region="UX")
        rows.append(count_by(encoded, "title", "n").withColumn("charset", F.lit(charset)))
    return reduce(DataFrame.unionByName, rows)


def report_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The head of a written report, read without sorting it."""
    path = shared_path(spark, "report")
    report = programs.most_viewed_channels(_snaps(spark, sf_dir))
    write_report(report, path, header=report.columns)
    return read_report_head(spark, path, "views bigint, channel string, likes bigint, dislikes bigint, comments bigint", 40, header=1)


def latin1_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines stored in another charset, decoded before the parse."""
    lines = model.regional_lines(spark, sf_dir)
    stored = lines.withColumn("value", F.encode("value", "ISO-8859-1"))
    return count_by(parse_snapshot_lines(decode_lines(stored, "ISO-8859-1")), "title", "n")


def united_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of single regions united are the whole."""
    names = [c for c in SNAPSHOT_COLUMNS if c not in STATS]
    snaps = _snaps(spark, sf_dir).best(names, REQUIRE_STATS)
    parts = [snaps.where(F.col("region") == r) for r in ("AF", "AM", "AS", "EU", "MI")]
    return programs.channel_totals(union_snapshots(*parts))


def report_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report whose names hold a tab and a backslash, written as
    lines under a header and read back."""
    totals = programs.channel_totals(_snaps(spark, sf_dir))
    odd = totals.withColumn("channel", F.concat("channel", F.lit("\t\\t")))
    report = programs.rank_report(odd, "views", ["channel"])
    header = spark.range(1).select(F.lit("\t".join(report.columns)).alias("value"))
    schema = "views bigint, channel string, likes bigint, dislikes bigint, comments bigint"
    return parse_report_lines(header.unionByName(to_tsv_lines(report)), schema)


def one_pass_best_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four best snapshots of every video from one aggregation, one below the other."""
    best = programs.best_snapshots(_snaps(spark, sf_dir))
    kinds = [one_of(best, kind).select(F.lit(kind).alias("kind"), "identity", F.col(payload).cast("string").alias("payload"), *STATS)
             for kind, (payload, _) in PAYLOADS.items()]
    return reduce(DataFrame.unionByName, kinds)


def one_pass_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2, Q4, Q5 from one pass over the snapshots: channels counted, channels and categories added up."""
    parts = programs.programs_of(programs.best_snapshots(_snaps(spark, sf_dir)), model.categories(spark, sf_dir), CATEGORY_REGION)
    long = lambda name, key, *stats: parts[name].select(
        F.lit(name).alias("report"), F.col(key).alias("name"), F.explode(F.map_from_arrays(
            F.array(*[F.lit(s) for s in stats]), F.array(*[F.col(s).cast("bigint") for s in stats]))).alias("stat", "value"))
    rows = [long("channelCount", "channel", "n"), long("channelStats", "channel", *STATS), long("categoryStats", "label", *STATS)]
    return reduce(DataFrame.unionByName, rows)


def _stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The snapshots merged, kept bucketed by identity."""
    return write_bucketed_stage(reduced_snapshots(_snaps(spark, sf_dir)), shared_path(spark, "snapshots"), "identity")


def bucketed_stage_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel totals of a stage that lies bucketed by identity."""
    return programs.channel_totals(_stage(spark, sf_dir))


def bucketed_stage_all_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stage bucketed by identity answers the row count (Q1), the video count
    (Q2) and the category views (Q7) of the snapshots it was made of."""
    stage = _stage(spark, sf_dir)
    reports = (("rows", programs.channel_row_count(stage), "channel", "n"), ("videos", programs.channel_video_count(stage), "channel", "n"),
               ("views", programs.category_views(stage, model.categories(spark, sf_dir)), "label", "views"))
    return reduce(DataFrame.unionByName, [df.select(F.lit(report).alias("report"), F.col(name).alias("name"), F.col(value).alias("value"))
                                          for report, df, name, value in reports])


def top_parts_with_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O6 with a tie across the cut: parts by number of rows."""
    counts = model.table(spark, sf_dir, "lineitem").groupBy(F.col("l_partkey").alias("part")).agg(F.count("*").alias("n"))
    return programs.top_k_with_ties(counts, "n", 5, ["part"])


def zero_view_rule_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Videos without a positive view count are not in the channel totals."""
    snaps = model.events_snapshots(spark, sf_dir)
    best = best_channel_snapshot(with_identity(valid_rows(snaps, REQUIRE_STATS)))
    return totals_by(best, "channel")


def zero_view_rule_empty_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D6 in the video count: such videos count under the channel ''."""
    snaps = model.events_snapshots(spark, sf_dir)
    return count_by(channel_of_video(with_identity(valid_rows(snaps, REQUIRE_VIEWS))), "channel", "n")


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "channel_row_count": lambda s, d: programs.channel_row_count(_snaps(s, d)),
        "channel_video_count": lambda s, d: programs.channel_video_ranking(_snaps(s, d)),
        "top5_channels_by_video_count": lambda s, d: programs.top_channels_by_video_count(_snaps(s, d), 5),
        "most_viewed_channels": lambda s, d: programs.most_viewed_channels(_snaps(s, d)),
        "top5_viewed_channels": lambda s, d: programs.top_viewed_channels(_snaps(s, d), 5),
    }
    for stat in STATS:
        q[f"channel_stats_by_{stat}"] = (lambda st: lambda s, d: programs.channel_stats(_snaps(s, d), st))(stat)
        q[f"video_stats_by_{stat}"] = (lambda st: lambda s, d: programs.video_stats(_snaps(s, d), st))(stat)
        q[f"category_stats_by_{stat}"] = (lambda st: _with_categories(
            lambda snaps, cats: programs.category_stats(snaps, cats, CATEGORY_REGION, st)))(stat)
    q["placeholder_identity"] = lambda s, d: programs.title_keyed_videos(_snaps(s, d))
    q["category_views_all_regions"] = _with_categories(programs.category_views)
    q["zero_view_rule_drop"] = zero_view_rule_drop
    q["zero_view_rule_empty_channel"] = zero_view_rule_empty_channel
    q["csv_arity_and_number_guard"] = csv_arity_and_number_guard
    q["category_json_dictionary"] = category_json_dictionary
    q["category_json_last_item_wins"] = category_json_last_item_wins
    q["channel_rows_with_headers"] = lambda s, d: programs.channel_row_count(_regional(s, d))
    q["channel_videos_without_headers"] = lambda s, d: programs.channel_video_count(_regional(s, d))
    q["views_by_region"] = views_by_region
    q["latin1_titles"] = latin1_titles
    q["regional_file_scan"] = regional_file_scan
    q["utf16_titles"] = utf16_titles
    q["report_head"] = report_head
    q["united_regions"] = united_regions
    q["report_round_trip"] = report_round_trip
    q["top_parts_with_ties"] = top_parts_with_ties
    q["tied_views_channel_totals"] = lambda s, d: programs.channel_totals(model.late_snapshots(s, d, tied_views=True))
    q["tied_views_channel_videos"] = lambda s, d: programs.channel_video_count(model.late_snapshots(s, d, tied_views=True))
    q["category_views_bad_ids"] = lambda s, d: programs.category_views(
        model.late_snapshots(s, d, bad_categories=True), model.categories(s, d))
    q["one_pass_best_snapshots"] = one_pass_best_snapshots
    q["one_pass_reports"] = one_pass_reports
    q["bucketed_stage_channels"] = bucketed_stage_channels
    q["bucketed_stage_all_rules"] = bucketed_stage_all_rules
    q["stat_correlations"] = lambda s, d: programs.stat_correlation(_snaps(s, d), digits=6)
    return q


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
