"""The driver's benchmark tables seen as trending snapshots.

There is no trending data among the benchmark tables, so one frame maps them
onto ``SNAPSHOT_SCHEMA`` (the same mapping is written as SQL in
``plans.oracle``):

* a lineitem row is a snapshot; its part is the video, its supplier the
  channel, the supplier's region the region, the part size the category;
* line numbers 7 and 6 carry the spreadsheet error codes instead of the id, so
  those rows are identified by their title (part name + return flag), which
  many parts share (identity groups of up to ~0.2% of all rows);
* views, likes, dislikes and comments come from the price, quantity, discount
  and tax.

Category dictionaries come from the region table alone: every region but
``MI`` has the ids 1 to 50 without 29, so that region and that id exercise the
fallback labels.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vidtrend.operators.late import LateSnapshots
from vidtrend.schema import PLACEHOLDER_IDS, SNAPSHOT_COLUMNS, STATS

# Model parameters (also used by the SQL oracle).
NAME_LINE, VALUE_LINE = 7, 6          # line numbers carrying the error codes
UNLABELLED_CATEGORY = 29              # no dictionary title anywhere
REGION_WITHOUT_DICTIONARY = "MI"
TITLE_BUCKETS = 20                    # ids i and i+20 share a title
LAST_CATEGORY = 50                    # ids of a dictionary: 1 to this


# Columns the model reads, with their stored types: declaring them skips the
# schema-inference job per table and per query.
TABLE_COLUMNS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
                "l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, "
                "l_returnflag STRING, l_linestatus STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_size INT",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "events": "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_COLUMNS:
        reader = reader.schema(TABLE_COLUMNS[name])
    return reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def late_snapshots(spark: SparkSession, sf_dir: str, bad_categories: bool = False, tied_views: bool = False) -> LateSnapshots:
    """The snapshots with their names still in the tables: facts are lineitem rows.

    ``bad_categories``: every tenth quantity carries a category that is not a
    number, in regions with and without a dictionary.  ``tied_views``: views cut to
    a few values per category, so the best views of most videos tie between
    snapshots with other statistics and channels (D7)."""
    li = table(spark, sf_dir, "lineitem")
    name_code, value_code = PLACEHOLDER_IDS
    code = F.when(F.col("l_linenumber") == NAME_LINE, F.lit(name_code)).when(F.col("l_linenumber") == VALUE_LINE, F.lit(value_code))
    likes = F.round("l_quantity").cast("bigint")
    facts = li.select(
        "l_partkey", "l_suppkey", code.alias("code"), F.col("l_returnflag").alias("flag"),
        F.when(code.isNotNull(), F.col("l_returnflag")).alias("code_flag"),   # a title is an identity only under a code
        (F.lit(bad_categories) & (likes % 10 == 3)).alias("bad"),
        _cents("l_extendedprice").alias("views"), likes.alias("likes"),
        _cents("l_discount").alias("dislikes"), _cents("l_tax").alias("comments"))
    keys = {"video_id": ("l_partkey", "code"), "title": ("l_partkey", "flag"), "identity": ("l_partkey", "code", "code_flag"),
            "token": ("l_partkey", "code", "flag"), "channel": ("l_suppkey",), "region": ("l_suppkey",),
            "category_raw": ("l_partkey", "bad"), "category_id": ("l_partkey", "bad")}
    if tied_views:
        facts, keys = facts.drop("views"), keys | {"views": ("l_partkey",)}

    def look_up(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
        wanted = set(columns)
        if wanted & {"title", "identity", "token", "category_raw", "category_id", "views"}:
            part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
            rows = rows.join(part, F.col("l_partkey") == F.col("p_partkey"))
        if wanted & {"channel", "region"}:
            supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
            rows = rows.join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        if "region" in wanted:
            nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
            region = table(spark, sf_dir, "region").select("r_regionkey", F.upper(F.substring("r_name", 1, 2)).alias("region"))
            rows = (rows.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
                    .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
        own_id = F.col("l_partkey").cast("string")
        title = lambda flag: F.concat("p_name", F.lit(" "), flag)
        found = {
            "video_id": F.coalesce("code", own_id),
            "title": title("flag"),
            "identity": F.when(F.col("code").isNotNull(), title("code_flag")).otherwise(own_id),
            "token": F.coalesce("code", title("flag")),
            "channel": F.col("s_name"),
            "region": F.col("region"),
            "category_raw": F.when(F.col("bad"), F.lit("x")).otherwise(F.col("p_size").cast("string")),
            "category_id": F.when(~F.col("bad"), F.col("p_size")),
            "views": F.col("p_size").cast("bigint") % 3,
        }
        kept = [c for c in rows.columns if c in ("_n", *STATS)]
        return rows.select(*[found[c].alias(c) for c in columns], *kept)

    return LateSnapshots(facts, keys, look_up)


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``SNAPSHOT_SCHEMA`` rows, one per lineitem row, all names looked up."""
    names = [c for c in SNAPSHOT_COLUMNS if c not in STATS]
    return late_snapshots(spark, sf_dir).frame(names).select(*SNAPSHOT_COLUMNS)


def categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(region, category_id, title)``: the dictionaries, from the region table."""
    region = table(spark, sf_dir, "region").select(F.upper(F.substring("r_name", 1, 2)).alias("region"))
    title = F.concat(F.lit("Category "), (F.col("category_id") % TITLE_BUCKETS).cast("string"))
    return (region.where(F.col("region") != REGION_WITHOUT_DICTIONARY)
            .select("region", F.explode(F.sequence(F.lit(1), F.lit(LAST_CATEGORY))).alias("category_id"))
            .where(F.col("category_id") != UNLABELLED_CATEGORY)
            .withColumn("title", title))


def order_dictionaries(spark: SparkSession, sf_dir: str, ids: Column) -> DataFrame:
    """Dictionary documents that grow with the facts: one JSON text (``json``) per order
    (``region``), an item per line of it, in the order of line number and title.
    ``ids``: an item's id.  A document holds the lines of one order, a few."""
    li = table(spark, sf_dir, "lineitem")
    item = F.struct(F.col("l_linenumber").alias("pos"), ids.cast("string").alias("id"),
                    F.struct(F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("title")).alias("snippet"))
    return (li.groupBy(F.col("l_orderkey").cast("string").alias("region"))
            .agg(F.to_json(F.struct(F.array_sort(F.collect_list(item)).alias("items"))).alias("json")))


def events_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshots for the no-winner rule (D6): each event is a video
    of channel ``event_type`` with ``floor(value)`` views; small values give
    zero-view videos."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    views = F.floor("value").cast("bigint")
    return ev.select(
        F.lit("EV").alias("region"),
        F.col("event_id").cast("string").alias("video_id"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("title"),
        F.col("event_type").alias("channel"),
        F.lit("0").alias("category_raw"),
        F.lit(0).alias("category_id"),
        views.alias("views"),
        F.col("user_id").alias("likes"),
        F.lit(0).cast("bigint").alias("dislikes"),
        F.lit(0).cast("bigint").alias("comments"),
    )


# Line numbers that break a generated CSV line, and how.
SHORT_LINE, LONG_LINE = 4, 6          # 15 and 17 fields
BAD_VIEWS_LINE = 3                    # views "abc"
BAD_CATEGORY_LINE = 5                 # category "x" (only category programs need it)
QUOTED_TITLE_LINE = 2                 # title with doubled quotes; likes empty when status 'O'
PADDED_LINE = 1                       # blanks / tab around fields, "+" before a count
# On the padded line, by order key modulo CASES:
CASES = 1009
WIDE = 21_000                         # commas: more fields than a CSV parser's usual limit
WIDE_LINE, WIDE_QUOTED = 1, 2         # too many fields; the same commas inside one quoted field
ESCAPED_QUOTE = (3, 40)               # backslash before a quote
STRAY_QUOTE = (41, 80)                # quoted part inside an unquoted field
DELETE_CHARACTER = (81, 120)          # number followed by U+007F
OPEN_QUOTE = (121, 160)               # the closing quote is escaped
HEADER_LINE = 7                       # line number with a header before and an empty line after it
HEADER_TEXT = "video_id,x,title,channel_title,category_id,x,x,views,likes,dislikes,comment_count,x,x,x,x,x"


def snapshot_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lineitem rows written as snapshot CSV lines (column ``value``), some
    broken on purpose, for the scan rules S1, P1, P3, P4."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus")
    ln = F.col("l_linenumber")
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    s = lambda c: c.cast("string")
    vid = F.concat(F.lit("v"), s(F.col("l_orderkey")), F.lit("-"), s(ln))
    video_id = (F.when(ln == NAME_LINE, F.lit(PLACEHOLDER_IDS[0]))
                .when(ln == PADDED_LINE, F.concat(F.lit("  "), vid, F.lit(" ")))
                .otherwise(vid))
    title = F.when(ln == QUOTED_TITLE_LINE,
                   F.concat(F.lit('"Say ""'), flag, F.lit('"""'))).otherwise(
        F.concat(F.lit('"Item, '), flag, F.lit('"')))
    channel = F.when(ln == PADDED_LINE, F.concat(F.lit("\t"), flag, status, F.lit(" "))).otherwise(
        F.concat(F.lit(" "), flag, status))
    category = F.when(ln == BAD_CATEGORY_LINE, F.lit("x")).otherwise(s(ln))
    views = F.when(ln == BAD_VIEWS_LINE, F.lit("abc")).otherwise(s(F.col("l_partkey")))
    likes = F.when((ln == QUOTED_TITLE_LINE) & (status == "O"), F.lit("")).otherwise(
        s(F.round("l_quantity").cast("bigint")))
    comments = F.when(ln == PADDED_LINE, F.concat(F.lit("+"), s(_cents("l_tax")))).otherwise(
        s(_cents("l_tax")))
    # Hard cases for the field cutting, on the padded line of some orders.
    case = F.when(ln == PADDED_LINE, F.col("l_orderkey") % CASES)
    title = (F.when(case == WIDE_QUOTED, F.concat(F.lit('"'), F.repeat(F.lit("a,"), WIDE), F.lit('"')))
             .when(case.between(*ESCAPED_QUOTE), F.lit('"a\\"b"'))
             .when(case.between(*STRAY_QUOTE), F.lit('a "b, c" d'))
             .when(case.between(*OPEN_QUOTE), F.lit('"a\\"'))
             .otherwise(title))
    views = F.when(case.between(*DELETE_CHARACTER), F.concat(views, F.lit("\x7f"))).otherwise(views)
    # Fields 11-15 are the literal "x"; a short line has one fewer, a long one
    # one more, so only the tail differs.
    tail = (F.when(ln == SHORT_LINE, F.lit(",x" * 4))
            .when(ln == LONG_LINE, F.lit(",x" * 6))
            .when(case == WIDE_LINE, F.repeat(F.lit(",x"), WIDE))
            .otherwise(F.lit(",x" * 5)))
    line = F.concat(video_id, F.lit(",x,"), title, F.lit(","), channel, F.lit(","), category,
                    F.lit(",x,x,"), views, F.lit(","), likes, F.lit(","), s(_cents("l_discount")),
                    F.lit(","), comments, tail)
    # Exploding a one-element array materialises the line once: the scan's
    # filters cannot be pushed below a generator and re-evaluate the builder.
    return li.select(F.explode(F.array(line)).alias("value"))


def regional_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Simple snapshot lines (``value``) of two regional files (``file_name``),
    with a header line before and an empty line after some of them, for the
    rules P2, P2a, P2b, P7 and S3."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus")
    line = F.concat_ws(",", F.concat(F.lit("v"), F.col("l_partkey")), F.lit("x"), F.lit("Café"),
                       F.concat(F.lit("ch"), F.col("l_suppkey")), F.lit("1,x,x"), F.col("l_orderkey"), F.col("l_linenumber"),
                       F.lit("1,1,x,x,x,x,x"))
    around = F.when((F.col("l_linenumber") == HEADER_LINE), F.array(F.lit(HEADER_TEXT), line, F.lit(""))).otherwise(F.array(line))
    name = F.when(F.col("l_linestatus") == "O", F.lit("INvideos.csv")).otherwise(F.lit("USvideos.csv"))
    return li.select(F.explode(around).alias("value"), name.alias("file_name"))
