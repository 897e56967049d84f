"""Main text of web pages by differencing each page with its nearest by URL.

Pages are ordered by host and URL path.  A page's partner is the neighbour on the
same host whose path shares the longer prefix with its own, and whose text is not
the same.  The text lines of both are aligned by longest common subsequence; the
shared lines are the site's template and are deleted.  Inside article elements, only those
go that the differing neighbours on both sides have at the same place of their articles:
a sentence that another article has too is no template.  Such lines stay if they are half or more of the text of
either page's articles: then the pages are near copies or one quotes the other, and
what they share is no template.  Lines in an element that says it is not content
(menus, forms, notices, ...) go too.

The order is cut into parts of about ``part_pages`` pages by the keys and a digest of
the lines.  Each part is also sent the nearest page on either side whose lines differ
from those at its edge, however far it is, so partners are the same however the pages
are dealt, and a host with a third of all pages is many parts.

Defined results: a null html is the empty text; pages with a null url are one host
without paths; a page without a partner loses no line by differencing; repeated
rows stay repeated; an empty table gives an empty result.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_left
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidtrend.llm.common import keep, small_batches

TAG = re.compile(r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|$)", re.S)
SPACE = re.compile(r"\s+")
HIDDEN = re.compile(r"(?:^|\s)hidden(?=[\s=/]|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
HINT = re.compile(r"(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
#: Elements whose text is never shown.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object"}
#: Elements that are not content.
ASIDE = {"nav", "footer", "aside", "form", "button", "select", "dialog", "menu", "head", "fieldset", "label"}
#: Words in class, id or role that say the same.
ASIDE_WORDS = set("""ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie
cookies consent disqus footer header menu modal nav navbar navigation newsletter notice notices popup promo related reply
replies search share sharing sidebar social sponsor sponsored subscribe toolbar widget contentinfo complementary""".split())
#: Words that make a header the article's own.
TITLE_WORDS = {"post", "entry", "article", "content", "title", "story"}
ARTICLE = {"article", "main"}
BLOCK = set("""address article aside blockquote body center dd details div dl dt fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hr html li main nav ol p pre section summary table tbody td tfoot th thead tr ul option legend
caption dir menu dialog head title""".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: A start tag of these ends an open element of the same kind.
REPEATS = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
           "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _not_content(name: str, attrs: str, inside_article: bool) -> bool:
    if name in ASIDE or name == "header" and not inside_article:
        return True
    if name in ("html", "body") or not attrs.strip():
        return False
    if HIDDEN.search(attrs):
        return True
    words = {w for m in HINT.findall(attrs) for w in re.split(r"[^a-z]+", " ".join(m).lower())}
    if inside_article or words & TITLE_WORDS:
        words.discard("header")  # the article's own
    return bool(words & ASIDE_WORDS)


def lines_of(page: str | None) -> list[tuple[str, int]]:
    """The page's text blocks in order: (text, kind); kind 0 is text, 1 is text of an
    article element, 2 is text of an element that is not content."""
    page = page or ""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    kind, at, text = 0, 0, []

    def close_block() -> None:
        line = SPACE.sub(" ", entities.unescape("".join(text))).strip()
        text.clear()
        if line:
            out.append((line, kind))

    while m := TAG.search(page, at):
        text.append(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        closing = (m[1] or m[4]) == "/"
        if name in BLOCK:
            close_block()
        elif name == "br":
            text.append(" ")
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    kind = stack[k][1]
                    del stack[k:]
                    break
            continue
        if name in RAW and not (m[3] or m[6] or "").endswith("/"):
            end = re.compile(rf"</{name}\s*>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID:
            continue
        while name in REPEATS and stack and stack[-1][0] in REPEATS[name]:
            kind = stack.pop()[1]
        stack.append((name, kind))
        if kind != 2:
            if _not_content(name, m[3] or m[6] or "", kind == 1):
                if text:
                    close_block()
                kind = 2
            elif name in ARTICLE:
                kind = 1
    text.append(page[at:])
    close_block()
    return out


def shared_lines(a: list[str], b: list[str]) -> list[int]:
    """Positions in ``a`` of a longest common subsequence of ``a`` and ``b``."""
    head = 0
    while head < len(a) and head < len(b) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    places: dict[str, list[int]] = {}
    for k in range(len(b) - tail - 1, head - 1, -1):  # last first: one place per line of a
        places.setdefault(b[k], []).append(k)
    # longest increasing run of places in b, over the lines of a in order
    ends: list[int] = []
    links: list[tuple[int, object]] = []
    for k in range(head, len(a) - tail):
        for j in places.get(a[k], ()):
            n = bisect_left(ends, j)
            link = (k, links[n - 1] if n else None)
            if n == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[n], links[n] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(head), *reversed(middle), *range(len(a) - tail, len(a))]


def _article(page: list[tuple[str, int]]) -> list[int]:
    return [k for k, (_, kind) in enumerate(page) if kind == 1]


def _fixed(lines: list[tuple[str, int]], near: list[list[tuple[str, int]]]) -> set[int]:
    """Article lines that every page of ``near`` has at the same place of its article, counted
    from the start in all of them or from the end in all of them."""
    own, found = _article(lines), set()
    others = [[page[k][0] for k in _article(page)] for page in near]
    for n, k in enumerate(own):
        for place in (n, n - len(own)):
            if all(-len(o) <= place < len(o) and o[place] == lines[k][0] for o in others):
                found.add(k)
    return found


def main_text(lines: list[tuple[str, int]], partner: list[tuple[str, int]] | None,
              near: list[list[tuple[str, int]]] | None = None) -> str:
    """The lines that stay once those shared with the partner are deleted.  ``near`` are the
    pages on either side that differ, the partner among them."""
    gone = set(shared_lines([t for t, _ in lines], [t for t, _ in partner])) if partner else set()
    common = {k for k in gone if lines[k][1] == 1}
    if common:
        # a sentence that another article has as well is no template
        gone -= common - _fixed(lines, near or [partner])
        common &= gone
    wholes = [n for n in (sum(len(t) for t, kind in page if kind == 1) for page in (lines, partner or ())) if n]
    if common and 2 * sum(len(lines[k][0]) for k in common) >= min(wholes):
        gone -= common
    return "\n".join(t for k, (t, kind) in enumerate(lines) if kind != 2 and k not in gone)


def url_key(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL; without scheme or host everything is path."""
    try:
        parts = urlsplit(url or "")
        return (parts.netloc.lower(), parts.path)
    except ValueError:
        return ("", url or "")


def _common(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def digest_of(lines: list[tuple[str, int]]) -> str:
    return hashlib.blake2b(repr(lines).encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


def _far(edges: list[tuple]) -> list:
    """For each part in order, the nearest page before it on its first page's host whose
    digest differs from that page's.  ``edges``: (first, last, last other) of each part,
    where ``last other`` is the last page on the last one's host that differs from it."""
    out: list = [None] * len(edges)
    for k in range(1, len(edges)):
        first, (begin, last, other) = edges[k][0], edges[k - 1]
        if last[0] != first[0]:
            continue
        if last[3] != first[3]:
            out[k] = last
        elif other is not None:
            out[k] = other
        elif begin[0] == first[0]:  # the part before holds copies alone
            out[k] = out[k - 1]
    return out


def extract(pages: DataFrame, part_pages: int = 2000, most_parts: int = 1 << 16) -> DataFrame:
    """(page_id, url, text) of every page of ``pages`` (page_id, url, html).

    ``most_parts`` bounds the part edges that every task gets; beyond it parts grow.
    """
    spark = pages.sparkSession
    small_batches(spark)

    def number(page_id: str | None) -> int:
        return -(1 << 63) if page_id is None else int(page_id)

    def keys(batches):
        for pdf in batches:
            found = [url_key(u) for u in pdf["url"]]
            yield pd.DataFrame({"host": [h for h, _ in found], "path": [p for _, p in found],
                                "page_id": [*map(number, pdf["page_id"])], "digest": [digest_of(lines_of(x)) for x in pdf["html"]]})

    # the order from the keys alone: first and last key of each part
    # ids pass through pandas as text: a column of longs with a null would become floats
    pages = pages.select(F.col("page_id").cast("string").alias("page_id"), "url", "html")
    slim = keep(pages.mapInPandas(keys, "host string, path string, page_id long, digest string"), "keys")
    count = min(most_parts, max(1, -(-slim.count() // part_pages)))
    names = ["host", "path", "page_id", "digest"]
    order = keep(slim.repartitionByRange(count, *names).select(F.struct(*names).alias("key"), F.spark_partition_id().alias("part")), "order")
    parts = order.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high"))

    def other(edge: str):  # the key, if it is on the edge's host and its lines differ
        return F.when((F.col("key.host") == F.col(f"{edge}.host")) & (F.col("key.digest") != F.col(f"{edge}.digest")), F.col("key"))

    inner = (order.join(parts, "part").groupBy("part")
             .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.min(other("low")).alias("low2"), F.max(other("high")).alias("high2")))
    edges = sorted((tuple(tuple(x) if x else () for x in (r.low, r.high, r.low2, r.high2)) for r in inner.collect()))  # four keys a part
    before = _far([(low, high, high2 or None) for low, high, _, high2 in edges])
    after = _far([(high, low, low2 or None) for low, high, low2, _ in reversed(edges)])[::-1]
    guests: dict[tuple, list[int]] = {}
    for part, both in enumerate(zip(before, after)):
        for k in both:
            if k is not None:
                guests.setdefault(k, []).append(part)
    shared = spark.sparkContext.broadcast(([e[1] for e in edges], guests))

    def parse(batches):
        high, guests = shared.value
        sent = set()  # one of equal rows is enough as a guest
        for pdf in batches:
            rows = []
            for page_id, url, page in zip(pdf["page_id"], pdf["url"], pdf["html"]):
                host, path = url_key(url)
                lines = lines_of(page)
                k = (host, path, number(page_id), digest_of(lines))
                to = [] if k in sent else guests.get(k, [])
                if to:
                    sent.add(k)
                rows.append([bisect_left(high, k), to, page_id, url, host, path, k[3], [t for t, _ in lines], [n for _, n in lines]])
            yield pd.DataFrame(rows, columns=["own", "others", "page_id", "url", "host", "path", "digest", "lines", "kinds"])

    def difference(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.iloc[sorted(range(len(pdf)), key=list(zip(pdf["host"], pdf["path"], map(number, pdf["page_id"]), pdf["digest"])).__getitem__)]
        hosts, paths, guests, digests = (pdf[c].tolist() for c in ("host", "path", "guest", "digest"))
        lines = [list(zip(t, k)) for t, k in zip(pdf["lines"], pdf["kinds"])]
        # the next page on either side whose text differs
        before, after = [-1] * len(lines), [-1] * len(lines)
        for k in range(1, len(lines)):
            if hosts[k - 1] == hosts[k]:
                before[k] = k - 1 if digests[k - 1] != digests[k] else before[k - 1]
        for k in range(len(lines) - 2, -1, -1):
            if hosts[k + 1] == hosts[k]:
                after[k] = k + 1 if digests[k + 1] != digests[k] else after[k + 1]
        texts = []
        for k in range(len(lines)):
            near = [j for j in (before[k], after[k]) if j >= 0]
            partner = max(near, key=lambda j: _common(paths[j], paths[k])) if near else None
            texts.append(None if guests[k] else main_text(lines[k], None if partner is None else lines[partner], [lines[j] for j in near]))
        out = pd.DataFrame({"page_id": pdf["page_id"], "url": pdf["url"], "text": texts})
        return out[[not g for g in guests]]

    parsed = pages.mapInPandas(
        parse, "own int, others array<int>, page_id string, url string, host string, path string, digest string, lines array<string>, kinds array<int>")
    to = F.concat(F.array(F.struct(F.col("own").alias("part"), F.lit(False).alias("guest"))),
                  F.transform("others", lambda k: F.struct(k.alias("part"), F.lit(True).alias("guest"))))
    parsed = parsed.withColumn("to", F.explode(to)).select("to.part", "to.guest", "page_id", "url", "host", "path", "digest", "lines", "kinds")
    found = parsed.groupBy("part").applyInPandas(difference, "page_id string, url string, text string")
    return found.withColumn("page_id", F.col("page_id").cast("long"))
