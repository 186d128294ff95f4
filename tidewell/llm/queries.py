"""Registered corpus queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import collocations, decontamination, language_model, licence_scan, line_dedup, near_dup, neighbours, packing, quality_crf, sharding, toxicity, url_filter, whitening
from tidewell.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


#: Rules of the url query: host, path, verdict.
URL_RULES = [
    url_filter.Rule("com", "/", "allow"),
    url_filter.Rule("example.com", "/en/", "block"),
    url_filter.Rule("www.example.com", "/en/", "allow"),
    url_filter.Rule("net", "/es/", "block"),
    url_filter.Rule("net", "/fr/", "block"),
]


def vocabulary() -> tuple[str, str]:
    """Tokenizer file and ranks file of the packing query."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its number of lines and the lines that go."""
    return line_dedup.line_report(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.language_scores(table(spark, sf_dir, "documents"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark items, with the items and the evidence."""
    return decontamination.benchmark_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), *vocabulary())


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licence_scan.scan_licences(table(spark, sf_dir, "documents"))


def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(table(spark, sf_dir, "embeddings"), count=20, every=20)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_crf.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", "n_segments")


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document; only sizes and checksums of the texts are moved."""
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return sharding.shuffle_shards(docs, shards=8).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), count=32)


REGISTRY: dict[str, Query] = {f.__name__: f for f in (op1_line_dedup, op2_lm_scoring, op3_benchmark_decontamination, op4_best_fit_packing, op5_url_filters, op6_license_scans, op7_nearest_neighbours, op8_quality_classifier, op9_toxicity, op10_minhash_near_dedup, op11_phrase_collocations, op12_sharding, op13_whitening)}
SQL: dict[str, str] = {
    "op5_url_filters": r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (
  SELECT page_id, regexp_extract(rest, '^([^/?#]*)', 1) AS raw, rest FROM parts
), cut AS (
  SELECT page_id, coalesce(translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(substr(rest, length(raw) + 1), '^([^?#]*)', 1), '') AS path FROM split
), rules(h, p, v) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM (
  SELECT page_id, host, path, h || p AS rule, v,
         row_number() OVER (PARTITION BY page_id ORDER BY length(h || p) DESC NULLS LAST) AS place
  FROM cut LEFT JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
) WHERE place = 1
""",
    "op11_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, doc, unnest(parts) AS piece, generate_subscripts(parts, 1) AS p FROM (
    SELECT lang, row_number() OVER () AS doc,
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n\x0B\f\r]') AS parts
    FROM documents)
), words AS (
  SELECT lang, doc, p, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM (SELECT lang, doc, p, regexp_extract_all(piece, '[^ \t]+') AS w FROM pieces)
), ahead AS (
  SELECT lang, word AS w1, lead(word, 1) OVER s AS w2, lead(word, 2) OVER s AS w3, lead(word, 3) OVER s AS w4
  FROM words WINDOW s AS (PARTITION BY doc, p ORDER BY i)
), counted AS (
  SELECT lang, 1 AS n, w1 AS phrase, count(*) AS f FROM ahead GROUP BY ALL
  UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM ahead WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM ahead WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM ahead WHERE w4 IS NOT NULL GROUP BY ALL
), known AS MATERIALIZED (
  SELECT lang || ':' || phrase AS id, f FROM counted WHERE f >= 30
), found AS MATERIALIZED (
  SELECT lang, n AS size, phrase, string_split(phrase, ' ') AS w, f AS a FROM counted WHERE n > 1 AND f >= 30
), cuts AS (
  SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:size], ' ') AS rest FROM found, range(1, 4) AS t(k) WHERE k < size
), begun AS MATERIALIZED (
  SELECT c.*, x.f AS l FROM cuts c JOIN known x ON x.id = c.lang || ':' || c.first
), scored AS (
  SELECT c.lang, c.phrase, c.a, c.k, l, y.f AS r, CAST(2000000::HUGEINT * c.a // (l + y.f) AS BIGINT) AS score
  FROM begun c JOIN known y ON y.id = c.lang || ':' || c.rest
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(a) AS longer
  FROM found, range(2, 4) AS t(m), range(1, 4) AS u(s) WHERE m < size AND s + m - 1 <= size GROUP BY ALL
)
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r, t.n, score
FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
JOIN (SELECT lang, count(*) AS n FROM words GROUP BY lang) t ON t.lang = b.lang
WHERE longer IS NULL OR 100 * longer < 80 * b.a
QUALIFY rank <= 2000
""",
}
