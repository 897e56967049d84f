from __future__ import annotations

import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from vidtrend.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def brute(rows, min_docs, alpha=5, top=50):
    counts, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for r in rows:
        lang, source = r.lang or "", r.source or ""
        found = Counter(re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(r.text or ""))
        counts[lang, source].update(found)
        docs[lang].update(found.keys())
        groups[lang].add(source)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in docs[lang].items() if n >= min_docs]

        def probabilities(n):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + alpha) // (total + alpha * len(kept)) for t in kept}

        whole = Counter()
        for s in sources:
            whole.update({t: counts[lang, s][t] for t in kept})
        q, p = probabilities(whole), {s: probabilities(counts[lang, s]) for s in sources}
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))[:limit]
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return sorted(out)


def result(df):
    return sorted((r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect())


def test_edge_rows(edge):
    rows = edge.collect()
    for min_docs in (1, 3, 10**6):
        assert result(divergence.audit(edge, min_docs=min_docs)) == brute(rows, min_docs)


def test_small_blocks_and_flushes_give_the_same(edge):
    rows = edge.collect()
    got = divergence.audit(edge, min_docs=2, top_terms=3, flush=5, term_block=7, source_block=1)
    assert result(got) == brute(rows, 2, top=3)


def test_whole_table(spark, tiny):
    documents = spark.read.parquet(f"{tiny}/documents.parquet")
    assert result(divergence.audit(documents, min_docs=30)) == brute(documents.collect(), 30)


def test_tokens_are_the_letters_and_all_that_is_not_ascii():
    text = "Ärger_x9 ÉTÉ's NBSP line \x00nul\x7f Zz"
    assert [t.decode() for t in divergence.terms(text.encode())] == [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text)]


def test_division_is_exact_for_large_counts(spark):
    n, total, kept = 7 * 10**12 + 3, 9 * 10**13 - 5, 123_457
    df = spark.range(1).select(divergence.probability(F.lit(n), F.lit(total), F.lit(kept), 5).alias("p"))
    assert df.first().p == 1 + 10**9 * (n + 5) // (total + 5 * kept)


def test_clashing_columns_and_empty_table(spark, edge, empty):
    odd = edge.withColumns({"term": F.lit("x"), "n": F.lit(1), "p": F.lit(2), "part": F.lit(3), "kept": F.lit(4), "Value": F.lit(5)}).drop("doc_id")
    assert result(divergence.audit(odd, min_docs=3)) == brute(edge.collect(), 3)
    assert divergence.audit(empty).count() == 0
    nothing = spark.createDataFrame([(1, None, None, None)], "doc_id long, text string, lang string, source string")
    assert divergence.audit(nothing).count() == 0
