"""The registered queries of this subpackage: each applies one operator, with
production parameters, to its whole table and derives the result's columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vidtrend.llm import (
    ann, decontaminate, divergence, hmm, html, license_scan, linededup, packing, passages, pivots, quality, simhash, warc,
)
from vidtrend.llm.common import crc_mod, shared_path, table

END_ID = 2


def word_bpe() -> str:
    """Path of the public word-BPE vocabulary, which the machines have installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def packed(documents: DataFrame) -> DataFrame:
    pieces = packing.pack(documents, word_bpe(), END_ID)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "source")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return license_scan.scan(documents, license_scan.fit(documents))


def op3_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    queries = vectors.where(F.col("vec_id") % 20 == 0).withColumnRenamed("vec_id", "query_id")
    return ann.search(vectors, queries, k=20)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "warc")
    warc.write(table(spark, sf_dir, "pages"), path, min_payload=100)
    return warc.read(spark, path)


def quality_model(documents: DataFrame, labels: DataFrame) -> quality.QualityModel:
    return quality.fit(documents, labels, lambda doc_id: crc_mod(doc_id, 4) != 2)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_model(documents, table(spark, sf_dir, "labels"))
    return (quality.score(documents, model)
            .select("doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), shingle=3, max_bits=2, columns=["doc_id"])
    return found.select("doc_id", "fingerprint", "component_id")


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", (crc_mod(F.col("doc_id"), 7) == 2).alias("held_out"))
    return hmm.score(documents)


def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = html.extract(table(spark, sf_dir, "pages"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (linededup.drop_frequent_lines(documents, min_docs=10, min_chars=1)
            .select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")))


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, alpha=5, top_terms=50)


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return passages.remove_repeats(documents, length=20).select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op13_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return pivots.cluster(vectors, k=16, rounds=3).drop("centroid")


OP10_SQL = """
WITH lines AS (
  SELECT doc_id, n, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n FROM documents)
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT doc_id, n, line, key IN (SELECT key FROM frequent) AS gone FROM lines
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


#: What the archives must say of every page; ids are unique here.
OP4_SQL = """
WITH own AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), first AS (
  SELECT payload_digest, min(page_id) AS first_id FROM own WHERE payload_bytes >= 100 GROUP BY payload_digest
)
SELECT page_id, payload_bytes, own.payload_digest,
       CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM own LEFT JOIN first ON own.payload_digest = first.payload_digest AND payload_bytes >= 100
"""


OP11_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 30
), langs AS (
  SELECT lang, count(*) AS v, sum(lang_n) AS n FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), cells AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM groups g LEFT JOIN cells USING (lang, source) GROUP BY g.lang, g.source
), p AS (
  SELECT t.lang, t.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (t.n + 5 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.lang_n + 5)) // (l.n + 5 * l.v) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN cells c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
), distances AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
), every AS (
  SELECT g.lang, g.source, 'pair' AS part, o.source AS item, coalesce(d.value, 0) AS value
  FROM groups g JOIN groups o ON g.lang = o.lang AND g.source <> o.source
  LEFT JOIN distances d ON d.lang = g.lang AND d.source = g.source AND d.item = o.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""


OP12_SQL = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS passage
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words)
), again AS (
  SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY passage ORDER BY doc_id, s) AS k FROM windows) WHERE k > 1
), places AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS s FROM words
), marked AS (
  SELECT doc_id, s, word, max(again.s IS NOT NULL) OVER (PARTITION BY doc_id ORDER BY s ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS gone
  FROM places LEFT JOIN again USING (doc_id, s)
), kept AS (
  SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY s) FILTER (WHERE NOT gone) AS text
  FROM marked GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


def _op13_sql(k: int = 16, rounds: int = 3) -> str:
    """The rounds one after the other: assign, then the floor of the mean of every component."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
, a{r} AS MATERIALIZED (
  SELECT vec_id, v, distance, number FROM (
    SELECT vec_id, v, number, distance, row_number() OVER (PARTITION BY vec_id ORDER BY distance, number) AS nth FROM (
      SELECT vec_id, v, number, list_sum([(v[i] - c[i]) * (v[i] - c[i]) FOR i IN range(1, 65)])::BIGINT AS distance
      FROM kept, c{r})) WHERE nth = 1
)""")
        if r < rounds:
            steps.append(f"""
, s{r} AS (
  SELECT number, list(x ORDER BY i) AS c FROM (
    SELECT number, i, floor(sum(v[i])::DECIMAL(38, 0) / count(*))::BIGINT AS x FROM a{r}, range(1, 65) t(i) GROUP BY number, i) GROUP BY number
), c{r + 1} AS MATERIALIZED (
  SELECT number, coalesce(s{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN s{r} USING (number)
)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF isfinite(x)]) = 64
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY key) - 1 AS number, v AS c
  FROM (SELECT v, sha256('1:' || vec_id) AS key FROM kept ORDER BY key LIMIT {k})
){"".join(steps)}
SELECT vec_id, number::INTEGER AS cluster, distance, sum(distance) OVER (PARTITION BY number)::BIGINT AS cluster_inertia,
       sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} USING (number)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_packing": op1_packing,
        "op2_license_scan": op2_license_scan,
        "op3_nearest": op3_nearest,
        "op4_warc": op4_warc,
        "op5_quality": op5_quality,
        "op6_decontamination": op6_decontamination,
        "op7_simhash": op7_simhash,
        "op8_language_model": op8_language_model,
        "op9_main_text": op9_main_text,
        "op10_line_dedup": op10_line_dedup,
        "op11_divergence": op11_divergence,
        "op12_passages": op12_passages,
        "op13_clusters": op13_clusters,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_warc": OP4_SQL, "op10_line_dedup": OP10_SQL, "op11_divergence": OP11_SQL, "op12_passages": OP12_SQL,
            "op13_clusters": _op13_sql()}
