from __future__ import annotations

import random

from pyspark.sql import functions as F

from vidtrend.llm import html
from vidtrend.llm.queries import op9_main_text

SCHEMA = "page_id long, url string, html string"


def template(article, k=0):
    return (f"<!DOCTYPE html><html><head><title>t{k}</title><style>p{{x}}</style><script>var a='<p>no</p>';</script></head><body>"
            f"<header><h1>Site</h1></header><nav><ul><li><a href='/'>Home</a></li></ul></nav><div class='ad'>Buy &amp; win</div>"
            f"{article}<section id=comments><p>First!</p></section><form><p>Mail</p></form><footer>&copy; me</footer></body></html>")


def test_blocks_of_a_page():
    page = template("<article><header><h1>A  title</h1></header><p>One&nbsp;&lt;two&gt;\n three<br>four<p>Five <b>six</b>"
                    "<!-- no --><aside>side</aside><div class=\"promo box\"><p>promo</p></div></article>")
    assert html.main_text(html.lines_of(page), None) == "A title\nOne <two> three four\nFive six"
    assert html.main_text(html.lines_of("a < b <i>c</i> &amp"), None) == "a < b c &"
    assert html.lines_of("<p>cut <b>short<a href='x") == [("cut short", 0)] and html.lines_of(None) == []
    assert html.lines_of("<script>x") == [] and html.lines_of("<p>a</p>b<script>x</script>c") == [("a", 0), ("bc", 0)]


def test_what_elements_say_of_themselves():
    page = ("<div class='post-header'><h1>T</h1></div><div class=site-header>S</div><div id='cookie-banner'>C</div><p hidden>H</p>"
            "<div style='display: none'>N</div><ul role=navigation><li>M</ul><p class='headline'>\u2003A&emsp;b</p>")
    assert html.main_text(html.lines_of(page), None) == "T\nA b"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
    return row[-1]


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(300):
        a, b = ([rng.choice("abcdef") for _ in range(rng.randrange(12))] for _ in "ab")
        places = html.shared_lines(a, b)
        assert len(places) == lcs(a, b) and places == sorted(set(places))
        at = iter(b)
        assert all(any(a[k] == y for y in at) for k in places)


def expected(rows):
    """The same pages in one list: the nearest by path on either side that differs."""
    rows = sorted(rows, key=lambda r: (*html.url_key(r[1]), -1 if r[0] is None else r[0]))
    lines, out = [html.lines_of(r[2]) for r in rows], []
    for k, (page_id, url, _) in enumerate(rows):
        host, path = html.url_key(url)
        near = []
        for step in (-1, 1):
            j = k + step
            while 0 <= j < len(rows) and html.url_key(rows[j][1])[0] == host:
                if lines[j] != lines[k]:
                    near.append(j)
                    break
                j += step
        partner = max(near, key=lambda j: html._common(html.url_key(rows[j][1])[1], path)) if near else None
        out.append((page_id, url, html.main_text(lines[k], None if partner is None else lines[partner], [lines[j] for j in near])))
    return sorted(out, key=str)


def pages():
    rows = [(k, f"http://news.example/{k % 4}/{k}", template(f"<div><h1>Head {k}</h1><p>Body of {k}</p><p>Read on</p></div>"
                                                            f"<div><p>Our notice</p></div>", k)) for k in range(60)]
    rows += [(100 + k, f"http://copy.example/{k}", template("<div><p>The same article</p></div>")) for k in range(5)]
    rows += [(200, "http://alone.example/x", template("<div><p>Alone</p></div>")), (201, None, None), (202, None, ""), (203, "http://[bad", "<p>x</p>"),
             (None, "http://news.example/0/z", template("<p>No id</p>")), (60, "http://news.example/0/60", "<p>Read on</p>"),
             (60, "http://news.example/0/60", "<p>Read on</p>"), (300, "http://q.example/a", template("<article><p>Quote</p></article>")),
             (301, "http://q.example/b", template("<article><p>Quote</p><p>More</p></article>")), (302, "http://long.example", "<p>w " * 20_000)]
    return rows


def test_template_lines_go_and_parts_do_not_matter(spark):
    rows = pages()
    df = spark.createDataFrame(rows, SCHEMA).withColumn("path", F.lit("x")).withColumn("part", F.lit(1)).repartition(3)
    for part_pages in (2000, 7):
        got = sorted((tuple(r) for r in html.extract(df, part_pages).collect()), key=str)
        assert [r for r in got if r[0] != 60] == [r for r in expected(rows) if r[0] != 60] and len(got) == len(rows)
    texts = {r[0]: r[2] for r in got}
    assert texts[7] == "Head 7\nBody of 7" and texts[100] == "The same article\n".strip()
    assert texts[300] == "Quote" and texts[301] == "Quote\nMore" and texts[201] == ""


def test_the_partner_decides_on_pages_with_articles(spark):
    def page(k):
        return template(f"<article><h1>Teaser {k}</h1><p>Text of teaser {k}</p><p>Read more</p></article><div><p>The body of page {k}</p><p>Our notice</p></div>", k)

    assert html.main_text(html.lines_of(page(0)), None) == "Teaser 0\nText of teaser 0\nRead more\nThe body of page 0\nOur notice"
    rows = [(k, f"http://site.example/{k}", page(k)) for k in range(3)]
    got = {r.page_id: r.text for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {k: f"Teaser {k}\nText of teaser {k}\nThe body of page {k}" for k in range(3)}


def test_a_sentence_of_two_articles_is_no_template(spark):
    def page(k, *body):
        return template(f"<article><h1>Head {k}</h1><p>By the desk</p>{''.join(f'<p>{x}</p>' for x in body)}<p>Our notice</p></article>", k)

    long = "A sentence that is long enough to be most of what there is to read on a page."
    rows = [(0, "http://s.example/0", page(0, "Zero. " + long, "Rain fell.")), (1, "http://s.example/1", page(1, "Rain fell.", "One. " + long, "a")),
            (2, "http://s.example/2", page(2, "Two. " + long, "x", "Rain fell.", "y")), (3, "http://s.example/3", page(3, "Three. " + long, "z", "q", "w", "Rain fell.", "e", "r"))]
    got = {r.page_id: r.text.split("\n") for r in html.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert all("Rain fell." in t and "Our notice" not in t and "By the desk" not in t and t[0] == f"Head {k}" for k, t in got.items())


def test_copies_longer_than_parts_find_the_pages_behind_them(spark):
    copy = "<p>Menu</p><p>Left</p><p>The copy</p><p>Right</p>"
    for ends in ((0, 30), (0,), (30,)):
        rows = [(k, f"http://copies.example/{k:02}", copy) for k in range(31)]
        for k in ends:
            rows[k] = (k, rows[k][1], f"<p>Menu</p><p>{'Right' if k else 'Left'}</p><p>Own {k}</p>")
        rows += [(40 + k, f"http://z.example/{k:02}", copy) for k in range(9)]
        got = sorted((tuple(r) for r in html.extract(spark.createDataFrame(rows, SCHEMA), 5).collect()), key=str)
        assert got == expected(rows)


def test_articles_of_near_copies_stay():
    a, b = (html.lines_of(f"<main><p>A long paragraph of both</p><p>Edit {k}</p></main>") for k in range(2))
    assert html.main_text(a, b) == "A long paragraph of both\nEdit 0"


def test_query_keeps_every_page(spark, tiny):
    rows = op9_main_text(spark, tiny).collect()
    source = {r.page_id: r for r in spark.read.parquet(f"{tiny}/pages.parquet").collect()}
    assert {r.page_id for r in rows} == set(source) and all(r.n_chars == len(r.text) and r.url == source[r.page_id].url for r in rows)
    for r in rows:
        article = source[r.page_id].html.split("<article>")[1].split("</article>")[0]
        title = html.lines_of(article.split("</h1>")[0])[0][0]
        assert r.text.startswith(title) and "©" not in r.text


def test_empty_table(spark):
    assert html.extract(spark.createDataFrame([], SCHEMA)).count() == 0
