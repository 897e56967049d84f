"""The programs against a plain-Python statement of the rules on random
snapshots with hot identities, error-coded ids, zero and missing counts,
unparsable categories and a region without a dictionary."""

from __future__ import annotations

import random
from collections import defaultdict

import pytest

from vidtrend.plans import programs as P
from vidtrend.schema import SNAPSHOT_SCHEMA

PH = ("#NAME?", "#VALUE!")
STATS = ("views", "likes", "dislikes", "comments")
DICT = {("IN", 1): "Music", ("IN", 2): "Film", ("IN", 3): "Music", ("US", 1): "Music", ("US", 4): "News"}


def random_snapshots(seed, n=400):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        # a third of all rows share one id: a hot group
        vid = "hot" if rnd.random() < 0.33 else rnd.choice(["a", "b", "c", "d", "e", "#NAME?", "#VALUE!", "video_id"])
        title = rnd.choice(["t1", "t2", "a", "Broken"])
        channel = rnd.choice(["ChA", "ChB", "ChC", ""])
        region = rnd.choice(["IN", "US", "XX"])
        cat_raw = rnd.choice(["1", "2", "3", "4", "9", "x"])
        cat = int(cat_raw) if cat_raw.isdigit() else None
        num = lambda: rnd.choice([None, 0, 1, 2, 5, 10, 50, 100, rnd.randint(0, 1000)])
        rows.append((region, vid, title, channel, cat_raw, cat, num(), num(), num(), num()))
    return rows


def valid(rows, required, drop_header=True):
    idx = {c: i for i, c in enumerate(("region", "video_id", "title", "channel", "category_raw",
                                        "category_id") + STATS)}
    out = []
    for r in rows:
        if drop_header and r[1] == "video_id":
            continue
        if any(r[idx[c]] is None for c in required):
            continue
        out.append(dict(zip(idx, r)))
    return out


def ident(r):
    return r["title"] if r["video_id"] in PH else r["video_id"]


def token(r):
    return r["video_id"] if r["video_id"] in PH else r["title"]


def best(rows, payload, ranked=STATS):
    groups = defaultdict(list)
    for r in rows:
        groups[ident(r)].append(r)
    out = {}
    for k, g in groups.items():
        # a statistic that did not parse comes last
        out[k] = max(g, key=lambda r: tuple((r[c] is not None, r[c] or 0) for c in ranked) + tuple(p(r) for p in payload))
    return out


def sums(items, key):
    acc = defaultdict(lambda: [0, 0, 0, 0])
    for r in items:
        for i, c in enumerate(STATS):
            acc[key(r)][i] += r[c]
    return acc


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_programs_match_rules(spark, seed):
    data = random_snapshots(seed)
    df = spark.createDataFrame(data, SNAPSHOT_SCHEMA).repartition(5)
    cats = spark.createDataFrame([(r, c, t) for (r, c), t in DICT.items()],
                                 "region string, category_id int, title string")

    # Q1: every row, header included
    q1 = defaultdict(int)
    for r in data:
        q1[r[3]] += 1
    assert {tuple(x) for x in P.channel_row_count(df).collect()} == set(q1.items())

    # Q2: channel of each video's best snapshot, of which only the views must parse; '' without a positive count
    b2 = best(valid(data, ["views"]), [lambda r: r["channel"]])
    q2 = defaultdict(int)
    for r in b2.values():
        q2[r["channel"] if r["views"] > 0 else ""] += 1
    assert {(c, n) for c, n in P.channel_video_count(df).collect()} == set(q2.items())

    # Q3/Q4: channel totals over best snapshots with a positive count
    b3 = [r for r in best(valid(data, STATS), [lambda r: r["channel"]]).values() if r["views"] > 0]
    q3 = sums(b3, lambda r: r["channel"])
    got = {r.channel: [r.views, r.likes, r.dislikes, r.comments] for r in P.channel_totals(df).collect()}
    assert got == dict(q3)

    # Q5: category totals labelled with region IN's dictionary after summing
    b5 = [r for r in best(valid(data, STATS + ("category_id",)), [lambda r: r["category_id"]]).values()
          if r["views"] > 0]
    q5 = sums(b5, lambda r: r["category_id"])
    got = {r.category_id: (r.label, [r.views, r.likes, r.dislikes, r.comments])
           for r in P.category_totals(df, cats, "IN").collect()}
    assert got == {c: (DICT.get(("IN", c), f"IN_{c}"), v) for c, v in q5.items()}

    # Q6: video table with printed ids
    b6 = best(valid(data, STATS), [token])
    want = set()
    for k, r in b6.items():
        if r["views"] <= 0:
            continue
        t = token(r)
        vid, title = ("N/A", k) if t in PH else (k, t)
        want.add((vid, title) + tuple(r[c] for c in STATS))
    got = {(r.video_id, r.title, r.views, r.likes, r.dislikes, r.comments) for r in P.video_table(df).collect()}
    assert got == want

    # Q7: max views per (id, title, region, category), labelled per row, then summed
    d5 = {}
    for r in valid(data, ["views"], drop_header=False):
        k = (r["video_id"], r["title"], r["region"], r["category_raw"])
        d5[k] = max(d5.get(k, 0), r["views"])
    known = {reg for reg, _ in DICT}
    q7 = defaultdict(int)
    for (vid, title, region, raw), v in d5.items():
        cat = int(raw) if raw.isdigit() else None
        if region in known and cat is None:
            continue
        title = DICT.get((region, cat)) if region in known else None
        q7[title if title is not None else f"{region}_{raw}"] += v
    assert {(r.label, r.views) for r in P.category_views(df, cats).collect()} == set(q7.items())
