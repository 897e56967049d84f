"""Scan rules: field count, header, trim, number parsing, region, encoding."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from vidtrend.operators.clean import REQUIRE_STATS, REQUIRE_VIEWS, valid_rows, with_identity
from vidtrend.sources import (
    categories_from_documents, parse_snapshot_lines, read_categories, read_snapshots,
    union_snapshots,
)
from vidtrend.schema import SNAPSHOT_COLUMNS, TRIM_CHARS


def lines_df(spark, lines):
    return spark.createDataFrame([(x,) for x in lines], "value string")


def test_schema_and_region_from_file_name(snapshots):
    assert tuple(snapshots.columns) == SNAPSHOT_COLUMNS
    regions = {r.region for r in snapshots.select("region").distinct().collect()}
    assert regions == {"IN", "US"}


def test_arity_and_empty_lines(snapshots):
    ids = [r.video_id for r in snapshots.collect()]
    # 15- and 17-field lines and the empty line are gone; headers stay until P2
    assert "v5" not in ids and "v6" not in ids
    assert ids.count("video_id") == 2
    assert snapshots.count() == 12 + 4  # IN: 12 lines of 16 fields (header incl.); US: 4


def test_trim_and_quotes(snapshots):
    row = snapshots.where(F.col("video_id") == "v9").first()
    assert (row.title, row.channel, row.views) == ("Pad", "ChB", 10)
    titles = {r.title for r in snapshots.where(F.col("video_id") == "v1").collect()}
    assert titles == {"Song, one", "Song, one (new)"}


def test_number_rules(snapshots):
    v4 = snapshots.where(F.col("video_id") == "v4").first()
    assert v4.views is None and v4.likes == 1
    v7 = snapshots.where(F.col("video_id") == "v7").first()
    assert v7.likes is None and v7.views == 40
    v8 = snapshots.where(F.col("video_id") == "v8").first()
    assert v8.category_id is None and v8.category_raw == "x"


def test_required_fields_per_program(snapshots):
    views_only = {r.video_id for r in valid_rows(snapshots, REQUIRE_VIEWS).collect()}
    all_stats = {r.video_id for r in valid_rows(snapshots, REQUIRE_STATS).collect()}
    assert "v7" in views_only and "v7" not in all_stats
    assert "v4" not in views_only
    assert "video_id" not in views_only


def test_java_trim_and_long_parse(spark):
    df = lines_df(spark, [
        "a,x,\tt ,c,1,x,x, +5 ,-3,1e3,12.0,x,x,x,x,x",
        "b,x,t,c,99999999999,x,x,9223372036854775807,9223372036854775808,,3.,x,x,x,x,x",
    ])
    got = parse_snapshot_lines(df, region="XX").orderBy("video_id").collect()
    a, b = got
    assert a.title == "t "  # NBSP is not a trim character
    assert (a.views, a.likes, a.dislikes, a.comments) == (5, -3, None, None)
    assert b.category_id is None and b.category_raw == "99999999999"
    assert (b.views, b.likes, b.dislikes, b.comments) == (9223372036854775807, None, None, None)
    assert TRIM_CHARS[0] == "\x00" and TRIM_CHARS[-1] == " " and len(TRIM_CHARS) == 33


def test_doubled_and_backslash_quotes(spark):
    doubled = lines_df(spark, ['a,x,"say ""hi""",c,1,x,x,1,1,1,1,x,x,x,x,x'])
    assert parse_snapshot_lines(doubled, region="XX").first().title == 'say "hi"'
    slashed = lines_df(spark, ['a,x,"say \\"hi\\", ok",c,1,x,x,1,1,1,1,x,x,x,x,x'])
    got = parse_snapshot_lines(slashed, region="XX").first()
    assert got.title == 'say "hi", ok'


def test_blanks_around_quoted_field(spark):
    df = lines_df(spark, ['a,x,  "Song, one"  ,c,1,x,x,1,1,1,1,x,x,x,x,x'])
    got = parse_snapshot_lines(df, region="XX").collect()
    assert [(r.video_id, r.title, r.channel) for r in got] == [("a", "Song, one", "c")]


def test_backslash_escapes(spark):
    df = lines_df(spark, ['a,x,"back\\\\slash, \\"q\\"",c,1,x,x,1,1,1,1,x,x,x,x,x'])
    got = parse_snapshot_lines(df, region="XX").first()
    assert got.title == 'back\\slash, "q"'


TAIL = ",c,1,x,x,7,1,1,1,x,x,x,x,x"


def parsed(spark, line, **how):
    return [(r.video_id, r.title, r.channel, r.views) for r in
            parse_snapshot_lines(lines_df(spark, [line]), region="XX", **how).collect()]


def test_lines_of_any_width(spark):
    wide = ",".join(["x"] * 30_000)
    assert parsed(spark, "a,x,t" + TAIL + "," + wide) == []
    assert parsed(spark, f'a,x,"{wide}"' + TAIL) == [("a", wide, "c", 7)]


def test_backslash_and_stray_quotes(spark):
    assert parsed(spark, 'a,x,"a\\"b"' + TAIL) == [("a", 'a"b', "c", 7)]
    assert parsed(spark, 'a,x,"a\\"' + TAIL) == []                       # the field stays open
    assert parsed(spark, 'a,x,a "b, c" d' + TAIL) == [("a", 'a "b, c" d', "c", 7)]
    assert parsed(spark, 'a,x,AC\\DC' + TAIL) == [("a", "ACDC", "c", 7)]
    assert parsed(spark, 'a,x,AC\\DC' + TAIL, escape="double") == [("a", "AC\\DC", "c", 7)]
    assert parsed(spark, 'a,x,"a\\"' + TAIL, escape="double") == [("a", "a\\", "c", 7)]


def test_numbers_are_signed_digits_only(spark):
    got = parse_snapshot_lines(lines_df(spark, ["a,x,t,c,1\x7f,x,x,5\x7f,+6,1.0,\x1f7\x00,x,x,x,x,x"]), region="XX").first()
    assert (got.category_id, got.views, got.likes, got.dislikes, got.comments) == (None, None, 6, None, 7)


def test_multiline_quoted_field_is_dropped(spark, tmp_path):
    path = tmp_path / "GBvideos.csv"
    path.write_text('ok,x,t,c,1,x,x,1,1,1,1,x,x,x,x,x\n'
                    'bad,x,t,c,1,x,x,1,1,1,1,x,x,x,x,"line one\nline two"\n')
    got = [r.video_id for r in read_snapshots(spark, str(path)).collect()]
    assert got == ["ok"]


def test_latin1_encoding(spark, tmp_path):
    path = tmp_path / "FRvideos.csv"
    path.write_bytes("v1,x,Café,Chaîne,1,x,x,5,1,1,1,x,x,x,x,x\n".encode("latin-1"))
    row = read_snapshots(spark, str(path), encoding="ISO-8859-1").first()
    assert (row.region, row.title, row.channel, row.views) == ("FR", "Café", "Chaîne", 5)


def test_region_override_and_file_list(spark, fixture_dirs):
    csv_dir = fixture_dirs[0]
    df = read_snapshots(spark, [os.path.join(csv_dir, "USvideos.csv")], region="ZZ")
    assert {r.region for r in df.collect()} == {"ZZ"}


def test_identity(snapshots):
    ids = with_identity(snapshots).where(F.col("title") == "Broken").select("identity", "token").collect()
    assert sorted((r.identity, r.token) for r in ids) == [("Broken", "#NAME?"), ("Broken", "#VALUE!")]


def test_read_categories(categories, spark, fixture_dirs):
    got = sorted(tuple(r) for r in categories.collect())
    assert got == [("IN", 10, "Music"), ("IN", 24, "Entertainment"),
                   ("US", 10, "Music"), ("US", 23, "Comedy"), ("US", 34, "Comedy")]
    one = read_categories(spark, fixture_dirs[1], region="US")
    assert one.count() == 3


def test_dictionary_last_item_wins_and_empty(spark):
    docs = spark.createDataFrame(
        [("AA", [("1", ("first",)), ("1", ("second",)), ("2", ("two",))]), ("BB", [])],
        "region string, items array<struct<id:string, snippet:struct<title:string>>>")
    got = sorted(categories_from_documents(docs).collect(), key=lambda r: (r.region, r.category_id or 0))
    assert [tuple(r) for r in got] == [("AA", 1, "second"), ("AA", 2, "two"), ("BB", None, None)]


def test_union_of_regional_frames_equals_folder_scan(spark, fixture_dirs, snapshots):
    csv_dir = fixture_dirs[0]
    parts = [read_snapshots(spark, os.path.join(csv_dir, f"{r}videos.csv")) for r in ("IN", "US")]
    got = sorted(map(tuple, union_snapshots(*parts).collect()), key=repr)
    assert got == sorted(map(tuple, snapshots.collect()), key=repr)


def test_label_by_region_rules(spark):
    from vidtrend.operators.lookup import label_by_region
    docs = spark.createDataFrame(
        [("AA", [("1", ("One",))]), ("BB", [])],
        "region string, items array<struct<id:string, snippet:struct<title:string>>>")
    cats = categories_from_documents(docs)
    rows = spark.createDataFrame(
        [("AA", "1", 1, 10), ("AA", "2", 2, 20), ("AA", "x", None, 30),
         ("BB", "5", 5, 40), ("BB", "x", None, 50), ("ZZ", "x", None, 60)],
        "region string, category_raw string, category_id int, views bigint")
    got = sorted((r.label, r.views) for r in label_by_region(rows, cats).collect())
    assert got == [("AA_2", 20), ("BB_5", 40), ("One", 10), ("ZZ_x", 60)]
