"""The queries of ``plans.catalog`` as plain SQL over the benchmark tables
(DuckDB dialect), used as the correctness oracle.

Tie-breaks follow the operators: the best snapshot is the one with the
highest (views, likes, dislikes, comments, payload text), every sum is cast to
bigint, ranks to int.
"""

from __future__ import annotations

from vidtrend.plans.model import (
    BAD_CATEGORY_LINE, BAD_VIEWS_LINE, CASES, DELETE_CHARACTER, ESCAPED_QUOTE, HEADER_LINE, LAST_CATEGORY,
    LONG_LINE, NAME_LINE, OPEN_QUOTE, PADDED_LINE, QUOTED_TITLE_LINE, REGION_WITHOUT_DICTIONARY, SHORT_LINE,
    STRAY_QUOTE, TITLE_BUCKETS, UNLABELLED_CATEGORY, VALUE_LINE, WIDE, WIDE_LINE, WIDE_QUOTED,
)
from vidtrend.schema import STATS

SNAPSHOTS_CTE = f"""
snap AS (
  SELECT upper(substr(r.r_name, 1, 2)) AS region,
         CASE l.l_linenumber WHEN {NAME_LINE} THEN '#NAME?' WHEN {VALUE_LINE} THEN '#VALUE!'
              ELSE CAST(l.l_partkey AS VARCHAR) END AS video_id,
         p.p_name || ' ' || l.l_returnflag AS title,
         s.s_name AS channel,
         CAST(p.p_size AS VARCHAR) AS category_raw,
         p.p_size AS category_id,
         CAST(round(l.l_extendedprice * 100) AS BIGINT) AS views,
         CAST(round(l.l_quantity) AS BIGINT) AS likes,
         CAST(round(l.l_discount * 100) AS BIGINT) AS dislikes,
         CAST(round(l.l_tax * 100) AS BIGINT) AS comments
  FROM lineitem l
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
),
snapi AS (
  SELECT *,
         CASE WHEN video_id IN ('#NAME?', '#VALUE!') THEN title ELSE video_id END AS identity,
         CASE WHEN video_id IN ('#NAME?', '#VALUE!') THEN video_id ELSE title END AS token
  FROM snap
),
cats AS (
  SELECT upper(substr(r_name, 1, 2)) AS region, CAST(i AS INTEGER) AS category_id,
         'Category ' || CAST(i % {TITLE_BUCKETS} AS VARCHAR) AS title
  FROM region, range(1, {LAST_CATEGORY} + 1) AS ids(i)
  WHERE upper(substr(r_name, 1, 2)) <> '{REGION_WITHOUT_DICTIONARY}' AND i <> {UNLABELLED_CATEGORY}
)"""

# The same snapshots with bad category ids, and with tied views.
BAD_SNAPSHOTS = SNAPSHOTS_CTE.replace("CAST(p.p_size AS VARCHAR) AS category_raw", """
         CASE WHEN CAST(round(l.l_quantity) AS BIGINT) % 10 = 3 THEN 'x' ELSE CAST(p.p_size AS VARCHAR) END AS category_raw""").replace(
    "p.p_size AS category_id", "CASE WHEN CAST(round(l.l_quantity) AS BIGINT) % 10 = 3 THEN NULL ELSE p.p_size END AS category_id")
TIED_SNAPSHOTS = SNAPSHOTS_CTE.replace("CAST(round(l.l_extendedprice * 100) AS BIGINT) AS views",
                                       "CAST(p.p_size % 3 AS BIGINT) AS views")

EVENTS_CTE = """
snapi AS (
  SELECT CAST(event_id AS VARCHAR) AS identity, event_type AS channel,
         CAST(floor(value) AS BIGINT) AS views, user_id AS likes,
         CAST(0 AS BIGINT) AS dislikes, CAST(0 AS BIGINT) AS comments
  FROM events
)"""

ORDER = "views DESC, likes DESC, dislikes DESC, comments DESC"
NULLS_LAST = "views DESC, likes DESC NULLS LAST, dislikes DESC NULLS LAST, comments DESC NULLS LAST"


def _best(payload: str, where: str = "views IS NOT NULL AND likes IS NOT NULL "
          "AND dislikes IS NOT NULL AND comments IS NOT NULL") -> str:
    return f"""
best AS (
  SELECT * FROM (
    SELECT identity, {payload}, views, likes, dislikes, comments,
           row_number() OVER (PARTITION BY identity ORDER BY {ORDER}, {payload} DESC) AS rn
    FROM snapi WHERE {where}
  ) WHERE rn = 1 AND views > 0
)"""


def _others(stat: str) -> str:
    return ", ".join(s for s in STATS if s != stat)


def _channel_totals(snapshots: str) -> str:
    return f"""
WITH {snapshots}, {_best("channel")},
tot AS (
  SELECT channel, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes,
         CAST(sum(dislikes) AS BIGINT) AS dislikes, CAST(sum(comments) AS BIGINT) AS comments
  FROM best GROUP BY channel
)"""


CHANNEL_TOTALS = _channel_totals(SNAPSHOTS_CTE)

VIDEO_TABLE = f"""
WITH {SNAPSHOTS_CTE}, {_best("token")},
vid AS (
  SELECT CASE WHEN token IN ('#NAME?', '#VALUE!') THEN 'N/A' ELSE identity END AS video_id,
         CASE WHEN token IN ('#NAME?', '#VALUE!') THEN identity ELSE token END AS title,
         views, likes, dislikes, comments
  FROM best
)"""

CATEGORY_REGION = "AM"

CATEGORY_TOTALS = f"""
WITH {SNAPSHOTS_CTE}, {_best("category_id", "views IS NOT NULL AND likes IS NOT NULL AND "
                              "dislikes IS NOT NULL AND comments IS NOT NULL AND category_id IS NOT NULL")},
tot AS (
  SELECT t.category_id,
         coalesce(c.title, '{CATEGORY_REGION}_' || CAST(t.category_id AS VARCHAR)) AS label,
         t.views, t.likes, t.dislikes, t.comments
  FROM (SELECT category_id, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes,
               CAST(sum(dislikes) AS BIGINT) AS dislikes, CAST(sum(comments) AS BIGINT) AS comments
        FROM best GROUP BY category_id) t
  LEFT JOIN (SELECT category_id, title FROM cats WHERE region = '{CATEGORY_REGION}') c
    ON t.category_id = c.category_id
)"""

def _channel_of_video(snapshots: str) -> str:
    return f"""
WITH {snapshots},
best AS (
  SELECT identity, CASE WHEN views > 0 THEN channel ELSE '' END AS channel FROM (
    SELECT identity, channel, views, likes, dislikes, comments,
           row_number() OVER (PARTITION BY identity ORDER BY {NULLS_LAST}, channel DESC) AS rn
    FROM snapi WHERE views IS NOT NULL
  ) WHERE rn = 1
),
cnt AS (SELECT channel, count(*) AS n FROM best GROUP BY channel)"""


CHANNEL_OF_VIDEO = _channel_of_video(SNAPSHOTS_CTE)


def _category_views(snapshots: str) -> str:
    return f"""
WITH {snapshots},
d5 AS (
  SELECT video_id, title, region, category_raw, category_id, greatest(max(views), 0) AS views
  FROM snap WHERE views IS NOT NULL
  GROUP BY video_id, title, region, category_raw, category_id
),
known AS (SELECT DISTINCT region FROM cats),
labelled AS (
  SELECT CASE WHEN k.region IS NOT NULL AND c.title IS NOT NULL THEN c.title
              ELSE d.region || '_' || d.category_raw END AS label,
         d.views
  FROM d5 d
  LEFT JOIN known k ON d.region = k.region
  LEFT JOIN cats c ON d.region = c.region AND d.category_id = c.category_id
  WHERE k.region IS NULL OR d.category_id IS NOT NULL
)
SELECT label, CAST(sum(views) AS BIGINT) AS views FROM labelled GROUP BY label ORDER BY label"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["channel_row_count"] = f"WITH {SNAPSHOTS_CTE} SELECT channel, count(*) AS n FROM snap GROUP BY channel"
    q["channel_video_count"] = f"{CHANNEL_OF_VIDEO} SELECT n, channel FROM cnt ORDER BY n DESC, channel"
    q["top5_channels_by_video_count"] = f"""{CHANNEL_OF_VIDEO}
SELECT n, channel, CAST(rnk AS INTEGER) AS rank FROM (
  SELECT n, channel, rank() OVER (ORDER BY n DESC) AS rnk FROM cnt
) WHERE rnk <= 5 ORDER BY rnk, channel"""
    q["most_viewed_channels"] = (f"{CHANNEL_TOTALS} SELECT views, channel, likes, dislikes, comments "
                                 f"FROM tot ORDER BY views DESC, channel")
    q["top5_viewed_channels"] = (f"{CHANNEL_TOTALS} SELECT views, channel, likes, dislikes, comments "
                                 f"FROM tot ORDER BY views DESC, channel LIMIT 5")
    for stat in STATS:
        q[f"channel_stats_by_{stat}"] = (
            f"{CHANNEL_TOTALS} SELECT {stat}, channel, {_others(stat)} FROM tot "
            f"ORDER BY {stat} DESC, channel")
        q[f"video_stats_by_{stat}"] = (
            f"{VIDEO_TABLE} SELECT {stat}, video_id, title, {_others(stat)} FROM vid "
            f"ORDER BY {stat} DESC, video_id, title")
        q[f"category_stats_by_{stat}"] = (
            f"{CATEGORY_TOTALS} SELECT {stat}, label, {_others(stat)}, category_id FROM tot "
            f"ORDER BY {stat} DESC, label, category_id")
    q["placeholder_identity"] = f"{VIDEO_TABLE} SELECT * FROM vid WHERE video_id = 'N/A'"
    q["category_views_all_regions"] = _category_views(SNAPSHOTS_CTE)
    q["category_views_bad_ids"] = _category_views(BAD_SNAPSHOTS)
    q["tied_views_channel_totals"] = f"{_channel_totals(TIED_SNAPSHOTS)} SELECT channel, views, likes, dislikes, comments FROM tot"
    q["tied_views_channel_videos"] = f"{_channel_of_video(TIED_SNAPSHOTS)} SELECT channel, n FROM cnt"
    q["united_regions"] = f"{CHANNEL_TOTALS} SELECT channel, views, likes, dislikes, comments FROM tot"
    q["report_round_trip"] = f"""{CHANNEL_TOTALS}
SELECT views, channel || chr(9) || chr(92) || 't' AS channel, likes, dislikes, comments FROM tot"""
    complete = "views IS NOT NULL AND likes IS NOT NULL AND dislikes IS NOT NULL AND comments IS NOT NULL"
    kinds = [f"""SELECT '{kind}' AS kind, identity, {text} AS payload, views, likes, dislikes, comments FROM (
  SELECT *, row_number() OVER (PARTITION BY identity ORDER BY {NULLS_LAST}, {payload} DESC) AS rn FROM snapi WHERE {where}
) WHERE rn = 1{winner}"""
             for kind, payload, text, where, winner in (
                 ("video", "token", "token", complete, " AND views > 0"), ("channel", "channel", "channel", complete, " AND views > 0"),
                 ("category", "category_id", "CAST(category_id AS VARCHAR)", f"{complete} AND category_id IS NOT NULL", " AND views > 0"),
                 ("counted", "channel", "CASE WHEN views > 0 THEN channel ELSE '' END", "views IS NOT NULL", ""))]
    q["one_pass_best_snapshots"] = f"WITH {SNAPSHOTS_CTE} " + " UNION ALL ".join(kinds)
    totals = " UNION ALL ".join(f"SELECT '{report}' AS report, {name} AS name, '{s}' AS stat, {s} AS value FROM ({sql})"
                                for report, name, sql in (("channelStats", "channel", f"{CHANNEL_TOTALS} SELECT * FROM tot"),
                                                          ("categoryStats", "label", f"{CATEGORY_TOTALS} SELECT * FROM tot"))
                                for s in STATS)
    q["one_pass_reports"] = f"""SELECT 'channelCount' AS report, channel AS name, 'n' AS stat, n AS value FROM ({CHANNEL_OF_VIDEO} SELECT * FROM cnt)
UNION ALL {totals}"""
    q["bucketed_stage_channels"] = f"{CHANNEL_TOTALS} SELECT channel, views, likes, dislikes, comments FROM tot"
    q["bucketed_stage_all_rules"] = f"""
SELECT 'rows' AS report, channel AS name, n AS value FROM ({q["channel_row_count"]})
UNION ALL SELECT 'videos', channel, n FROM ({q["channel_video_count"]})
UNION ALL SELECT 'views', label, views FROM ({q["category_views_all_regions"]})"""
    q["top_parts_with_ties"] = """
SELECT part, n, CAST(rnk AS INTEGER) AS rank FROM (
  SELECT part, n, rank() OVER (ORDER BY n DESC) AS rnk FROM (
    SELECT l_partkey AS part, count(*) AS n FROM lineitem GROUP BY l_partkey)
) WHERE rnk <= 5"""
    q["category_json_last_item_wins"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS region, id AS category_id,
       CASE WHEN id IS NOT NULL THEN max({'n': l_linenumber, 'title': title}).title END AS title
FROM (SELECT l_orderkey, l_linenumber, 'Part ' || CAST(l_partkey AS VARCHAR) AS title,
             CASE WHEN l_linenumber <> 5 THEN l_linenumber % 3 END AS id FROM lineitem) GROUP BY l_orderkey, id"""
    q["regional_file_scan"] = """
SELECT scan, region, n, views FROM (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'IN' ELSE 'US' END AS region, count(*) AS n, CAST(sum(l_orderkey) AS BIGINT) AS views
  FROM lineitem GROUP BY 1), (VALUES ('all'), ('one')) AS scans(scan)
WHERE scan = 'all' OR region = 'IN'"""
    q["report_head"] = f"""{CHANNEL_TOTALS}
SELECT views, channel, likes, dislikes, comments, row_number() OVER (ORDER BY views DESC, channel) - 1 AS position
FROM tot ORDER BY views DESC, channel LIMIT 40"""
    headers = f"SELECT count(*) FROM lineitem WHERE l_linenumber = {HEADER_LINE}"
    q["channel_rows_with_headers"] = f"""
SELECT 'ch' || CAST(l_suppkey AS VARCHAR) AS channel, count(*) AS n FROM lineitem GROUP BY l_suppkey
UNION ALL SELECT 'channel_title', ({headers}) WHERE ({headers}) > 0"""
    q["channel_videos_without_headers"] = """
SELECT channel, count(*) AS n FROM (
  SELECT l_partkey, 'ch' || CAST(l_suppkey AS VARCHAR) AS channel,
         row_number() OVER (PARTITION BY l_partkey ORDER BY l_orderkey DESC, l_linenumber DESC,
                            'ch' || CAST(l_suppkey AS VARCHAR) DESC) AS rn,
         l_orderkey AS views
  FROM lineitem
) WHERE rn = 1 AND views > 0 GROUP BY channel"""
    q["views_by_region"] = """
SELECT CASE WHEN l_linestatus = 'O' THEN 'IN' ELSE 'US' END AS region, count(*) AS n,
       CAST(sum(l_orderkey) AS BIGINT) AS views
FROM lineitem GROUP BY 1"""
    q["latin1_titles"] = f"""
SELECT 'Café' AS title, count(*) AS n FROM lineitem HAVING count(*) > 0
UNION ALL SELECT 'title', ({headers}) WHERE ({headers}) > 0"""
    q["utf16_titles"] = f"""
SELECT charset, title, n FROM ({q["latin1_titles"]}), (VALUES ('UTF-16LE'), ('UTF-16BE')) AS charsets(charset)"""
    q["zero_view_rule_drop"] = f"""
WITH {EVENTS_CTE}, {_best("channel")}
SELECT channel, CAST(sum(views) AS BIGINT) AS views, CAST(sum(likes) AS BIGINT) AS likes,
       CAST(sum(dislikes) AS BIGINT) AS dislikes, CAST(sum(comments) AS BIGINT) AS comments
FROM best GROUP BY channel"""
    q["zero_view_rule_empty_channel"] = f"""
WITH {EVENTS_CTE},
best AS (
  SELECT identity, CASE WHEN views > 0 THEN channel ELSE '' END AS channel FROM (
    SELECT identity, channel, views, likes, dislikes, comments,
           row_number() OVER (PARTITION BY identity ORDER BY {NULLS_LAST}, channel DESC) AS rn
    FROM snapi WHERE views IS NOT NULL
  ) WHERE rn = 1
)
SELECT channel, count(*) AS n FROM best GROUP BY channel"""
    case = f"CASE WHEN l_linenumber = {PADDED_LINE} THEN l_orderkey % {CASES} END"
    q["csv_arity_and_number_guard"] = f"""
SELECT CASE WHEN l_linenumber = {NAME_LINE} THEN '#NAME?'
            ELSE 'v' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) END AS video_id,
       CASE WHEN l_linenumber = {QUOTED_TITLE_LINE} THEN 'Say "' || l_returnflag || '"'
            WHEN {case} = {WIDE_QUOTED} THEN repeat('a,', {WIDE})
            WHEN {case} BETWEEN {ESCAPED_QUOTE[0]} AND {ESCAPED_QUOTE[1]} THEN 'a"b'
            WHEN {case} BETWEEN {STRAY_QUOTE[0]} AND {STRAY_QUOTE[1]} THEN 'a "b, c" d'
            ELSE 'Item, ' || l_returnflag END AS title,
       l_returnflag || l_linestatus AS channel,
       CASE WHEN l_linenumber = {BAD_CATEGORY_LINE} THEN 'x' ELSE CAST(l_linenumber AS VARCHAR) END AS category_raw,
       CASE WHEN l_linenumber = {BAD_CATEGORY_LINE} THEN NULL ELSE l_linenumber END AS category_id,
       l_partkey AS views,
       CAST(round(l_quantity) AS BIGINT) AS likes,
       CAST(round(l_discount * 100) AS BIGINT) AS dislikes,
       CAST(round(l_tax * 100) AS BIGINT) AS comments
FROM lineitem
WHERE l_linenumber NOT IN ({SHORT_LINE}, {LONG_LINE}, {BAD_VIEWS_LINE})
  AND NOT (l_linenumber = {QUOTED_TITLE_LINE} AND l_linestatus = 'O')
  AND NOT coalesce({case} = {WIDE_LINE}
                   OR {case} BETWEEN {DELETE_CHARACTER[0]} AND {DELETE_CHARACTER[1]}
                   OR {case} BETWEEN {OPEN_QUOTE[0]} AND {OPEN_QUOTE[1]}, false)"""
    q["category_json_dictionary"] = """
SELECT CAST(l_orderkey AS VARCHAR) AS region, l_linenumber AS category_id, max('Part ' || CAST(l_partkey AS VARCHAR)) AS title
FROM lineitem GROUP BY l_orderkey, l_linenumber"""
    pairs = [(a, b) for i, a in enumerate(STATS) for b in STATS[i + 1:]]
    corr_rows = " UNION ALL ".join(
        f"SELECT '{a}' AS stat_a, '{b}' AS stat_b, round(corr({a}, {b}), 6) AS r FROM vid"
        for a, b in pairs)
    q["stat_correlations"] = f"{VIDEO_TABLE} {corr_rows}"
    return q


ORACLE_SQL = _sql()
