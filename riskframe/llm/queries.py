"""The registered queries of the operators: (spark, sf_dir) -> DataFrame over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm import (decontaminate, hard_negatives, html_extract, near_dedup, ngram_lm, packing, pii, quality_classifier,
                           quality_rules, resampling, signature_join, substring_dedup, url_filter)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark, sf_dir):
    """Personal data of every document."""
    return pii.find_pii(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "scores")


def op2_packing(spark, sf_dir):
    """Every document's token chunks in optimal length buckets and token-budget batches."""
    return packing.pack(_table(spark, sf_dir, "documents"))


def op3_html_extract(spark, sf_dir):
    """Main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op4_url_filter(spark, sf_dir):
    """Verdict on every page's url."""
    return url_filter.judge_urls(_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op5_quality_rules(spark, sf_dir):
    """Fixed rules and robust outliers over every document."""
    return quality_rules.judge(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_substring_dedup(spark, sf_dir):
    """Words of every document left after removing repeated 20-word windows."""
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256")


def op7_decontamination(spark, sf_dir):
    """Every (document, benchmark item) overlap."""
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_lm_score(spark, sf_dir):
    """Language-model score of every document, trained on four fifths of them."""
    return ngram_lm.score_texts(_table(spark, sf_dir, "documents"), order=3)


def op9_minhash_dedup(spark, sf_dir):
    """Near-duplicate component of every document."""
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def op10_quality_classifier(spark, sf_dir):
    """Quality score of every document, learned from labels outside the held-out fold."""
    return quality_classifier.score_quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).select(
        "doc_id", "held_out", "score", F.col("predicted").cast("int").alias("predicted"))


def op11_hard_negatives(spark, sf_dir):
    """Hard negatives of every anchor and positive."""
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


def op12_jaccard_join(spark, sf_dir):
    """Component of every document under four-word Jaccard links."""
    return signature_join.jaccard_components(_table(spark, sf_dir, "documents"))


def op13_importance_resampling(spark, sf_dir):
    """Importance weight, score and draw of every document, towards the benchmark's word runs."""
    return resampling.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_features", "weight", "score", "rank")


QUERIES = {f.__name__: f for f in (
    op1_pii, op2_packing, op3_html_extract, op4_url_filter, op5_quality_rules, op6_substring_dedup,
    op7_decontamination, op8_lm_score, op9_minhash_dedup, op10_quality_classifier,
    op11_hard_negatives, op12_jaccard_join, op13_importance_resampling)}

#: Words are runs of characters other than space and tab..carriage return.
_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

#: DuckDB SQL of the queries that SQL can express whole.
ORACLE = {
    "op6_substring_dedup": f"""
WITH t AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 19), ' ') AS key
        FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 19)) AS i FROM t WHERE len(ws) >= 20)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY key ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM rep),
lists AS (SELECT doc_id, list(i) AS gs FROM gone GROUP BY doc_id),
w AS (SELECT doc_id, unnest(ws) AS w, unnest(generate_series(1, len(ws))) AS i FROM t),
kept AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS txt FROM w ANTI JOIN gone USING (doc_id, i) GROUP BY w.doc_id)
SELECT t.doc_id, CAST(len(t.ws) AS BIGINT) AS n_words, CAST(coalesce(len(gs), 0) AS BIGINT) AS n_removed,
       sha256(coalesce(txt, '')) AS kept_sha256
FROM t LEFT JOIN lists USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op13_importance_resampling": r"""
WITH low AS (SELECT 'd' AS side, doc_id AS id, row_number() OVER () AS rn, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
             UNION ALL
             SELECT 'b', item_id, row_number() OVER (), translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') FROM benchmark),
split AS (SELECT side, id, rn, list_filter(string_split_regex(text, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS ws FROM low),
runs AS (SELECT side, rn, unnest(list_concat(ws, list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]))) AS f FROM split),
crc_table AS (SELECT list(c ORDER BY n) AS tab FROM (SELECT n, list_reduce(list_concat([n], generate_series(1, 8)), lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS c FROM (SELECT unnest(generate_series(0, 255)) AS n))),
coded AS (SELECT f, list_reduce(list_concat([4294967295], list_transform(generate_series(1, octet_length(encode(f))), lambda i: 16 * (strpos('0123456789ABCDEF', substr(hex(encode(f)), 2 * i - 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(hex(encode(f)), 2 * i, 1)) - 1)),
                 lambda a, b: xor(a // 256, tab[xor(a % 256, b) + 1])) AS raw FROM (SELECT DISTINCT f FROM runs), crc_table),
bucketed AS (SELECT side, rn, xor(raw, 4294967295) % 10000 AS bucket FROM runs JOIN coded USING (f)),
counts AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM bucketed GROUP BY bucket),
gains AS (SELECT bucket, CAST(floor(1000 * ln((CAST(t AS DOUBLE) + 1) * (CAST(sum(s) OVER () AS DOUBLE) + 10000) / ((CAST(s AS DOUBLE) + 1) * (CAST(sum(t) OVER () AS DOUBLE) + 10000)))) AS BIGINT) AS gain FROM counts),
per_doc AS (SELECT rn, count(*) AS n, sum(gain) AS total FROM bucketed JOIN gains USING (bucket) WHERE side = 'd' GROUP BY rn),
weighed AS (SELECT id AS doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_features, coalesce(CAST(total - ((total % n) + n) % n AS BIGINT) // n, 0) AS weight,
                   sha256('7:' || coalesce(CAST(id AS VARCHAR), '')) AS digest FROM split LEFT JOIN per_doc USING (rn) WHERE side = 'd'),
scored AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(digest, 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score FROM weighed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY n_words >= 20) AS able FROM scored)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN n_words >= 20 AND place <= 25 * able // 100 THEN place END AS BIGINT) AS rank FROM ranked""",
    "op11_hard_negatives": """
WITH v AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, a.q AS aq, c.vec_id AS id, a.label = c.label AS same,
                  CAST(list_inner_product(CAST(a.q AS DOUBLE[]), CAST(c.q AS DOUBLE[])) AS BIGINT) AS score
           FROM v a JOIN v c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
pos AS (SELECT anchor_id, aq, id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id, aq ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.aq, p.positive_id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank,
       n.id AS negative_id, p.positive_score, n.score AS negative_score
FROM pos p JOIN scored n ON n.anchor_id = p.anchor_id AND n.aq = p.aq AND NOT n.same
  AND 80 * p.positive_score <= 100 * n.score AND 100 * n.score <= 100 * p.positive_score
QUALIFY rank <= 5""",
    "op12_jaccard_join": r"""
WITH RECURSIVE t AS (SELECT row_number() OVER () AS rn, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws FROM documents),
s AS (SELECT rn, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct(list_transform(generate_series(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS fs FROM t),
e AS (SELECT rn, doc_id, len(fs) AS n, unnest(fs) AS f FROM s),
links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.f = b.f AND a.rn <> b.rn
          GROUP BY a.rn, b.rn, a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (SELECT DISTINCT doc_id AS a, doc_id AS b FROM s UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT s.doc_id, CAST(len(fs) AS BIGINT) AS n_shingles, c.component_id
FROM s JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = s.doc_id""",
}
