"""Column names, schemas and fixed values of the trending-snapshot data model.

Every frame that flows between operators is typed; text only exists at the
scan (raw CSV fields) and at the TSV sink.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the original programs' values) -------------
# Spreadsheet error codes that replace a video id in the exported CSV; a row
# with one of them is identified by its title instead.
PLACEHOLDER_IDS = ("#NAME?", "#VALUE!")
# Printed in place of the id of a video identified by its title.
MISSING_ID = "N/A"
# Literal first field of a CSV header line.
HEADER_ID = "video_id"
# Exact number of fields of a snapshot line.
SNAPSHOT_ARITY = 16
# Characters removed at both ends of every field (Java String.trim(): U+0000..U+0020).
TRIM_CHARS = "".join(chr(c) for c in range(0x00, 0x21))
# Separator between region and raw category id in fallback labels, e.g. "IN_29".
LABEL_SEP = "_"
# The four statistics, in input-column order.
STATS = ("views", "likes", "dislikes", "comments")
# Output folder of the ranking by each statistic.
REPORT_NAMES = {"views": "viewStats", "likes": "likeStats",
                "dislikes": "dislikesStats", "comments": "commentStats"}
# Output folders of the first and second intermediate stage and of the
# category-views report.
STAGE_1, STAGE_2, CATEGORY_VIEWS_REPORT = "Inter_1", "Inter_2", "catViews"
# Header words of the channel-count report.
COUNT_HEADER = ("Count", "Channel_name")
# --------------------------------------------------------------------------

# Positions 0..15 of a snapshot line.  Only 0, 2, 3, 4, 7, 8, 9, 10 are read.
RAW_COLUMNS = (
    "video_id", "col_01", "title", "channel", "category_raw", "col_05", "col_06",
    "views_raw", "likes_raw", "dislikes_raw", "comments_raw",
    "col_11", "col_12", "col_13", "col_14", "col_15",
)
assert len(RAW_COLUMNS) == SNAPSHOT_ARITY
# A parsed, trimmed snapshot.  Counts that do not parse are null; which of
# them must parse is decided per program by ``operators.clean.valid_rows``.
SNAPSHOT_SCHEMA = T.StructType([
    T.StructField("region", T.StringType(), True),
    T.StructField("video_id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("category_raw", T.StringType(), True),
    T.StructField("category_id", T.IntegerType(), True),
    T.StructField("views", T.LongType(), True),
    T.StructField("likes", T.LongType(), True),
    T.StructField("dislikes", T.LongType(), True),
    T.StructField("comments", T.LongType(), True),
])
SNAPSHOT_COLUMNS = tuple(f.name for f in SNAPSHOT_SCHEMA.fields)

# One category dictionary document: {"items": [{"id": "10", "snippet": {"title": "Music"}}]}
DICTIONARY_SCHEMA = T.StructType([
    T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType(), True),
        T.StructField("snippet", T.StructType([
            T.StructField("title", T.StringType(), True),
        ]), True),
    ])), True),
])
