"""One registered query per operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hostlake.llm import (alignment, arc, bpe, decontaminate, fertility, fuzzy_lines, hamming_topk, mixing, periodic_runs,
                          repeats, rule_ensemble, simhash_golay, url_rules)

RANKS, PIECES, BYTE_LEVEL = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model", "byte_bpe_50k.json"
#: The URL rules of op2, (host, path, verdict).
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]
#: Shares of the mixed corpus: a large source taken down, small ones repeated; the rest shares what is left.
MIX = {"src0": 0.10, "src1": 0.08, "src2": 0.06, "src3": 0.02}
MIX_OTHER, MIX_SEED = 0.74, 20


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility.tokeniser_rules(_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                     public_tokenizers.PATTERN, public_tokenizers.path(PIECES))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(_table(spark, sf_dir, "pages"), url_rules.rule_table(spark, URL_RULES))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(RANKS),
                                public_tokenizers.PATTERN, ids=False)


def op4_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return arc.archive_pages(_table(spark, sf_dir, "pages"), min_bytes=0)


def op5_poisson_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.poisson_mix(_table(spark, sf_dir, "documents"), MIX, MIX_OTHER, MIX_SEED)


def op6_hamming_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = _table(spark, sf_dir, "embeddings").select("vec_id", hamming_topk.sign_code(F.col("embedding")).alias("code"))
    return hamming_topk.top_k(codes, codes.where("vec_id % 100 = 0"), k=10)


def op7_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_golay.near_duplicates(_table(spark, sf_dir, "documents"), words_per_shingle=3, max_bits=2)


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return fuzzy_lines.dedup_lines(docs, counts=True).select(
        "doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"), length=50, texts=False)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_planted_periods(_table(spark, sf_dir, "documents"))
    return periodic_runs.periodic_runs(docs, texts=False)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_LEVEL),
                                     public_tokenizers.path(PIECES))


def op13_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), details=False)


QUERIES = {f.__name__: f for f in (
    op1_token_fertility, op2_url_rules, op3_byte_bpe, op4_arc_to_warc, op5_poisson_mix, op6_hamming_topk,
    op7_rule_ensemble, op8_simhash_golay, op9_fuzzy_lines, op10_repeats, op11_periodic_runs,
    op12_token_alignment, op13_decontaminate)}

ORACLE: dict[str, str] = {}

ORACLE["op2_url_rules"] = r"""
WITH u AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                      ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
m AS (SELECT DISTINCT host, path, h || p AS rule, v FROM u, r
      WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)),
b AS (SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v FROM m GROUP BY host, path)
SELECT page_id, u.host, u.path, b.rule, coalesce(b.v, 'allow') AS verdict
FROM u LEFT JOIN b ON u.host = b.host AND u.path = b.path
"""

ORACLE["op4_arc_to_warc"] = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
d AS (SELECT page_id, h, strlen(html) AS payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(h, 1 + 5 * (i // 4), 5))::BIGINT
               >> (15 - 5 * (i % 4))) & 31)::INT), 1)), '') AS payload_digest FROM p),
l AS (SELECT h, max(page_id) AS last FROM d GROUP BY h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM d JOIN l USING (h)
"""

ORACLE["op5_poisson_mix"] = r"""
WITH RECURSIVE w(s, weight) AS (VALUES ('src0', 0.10::DOUBLE), ('src1', 0.08), ('src2', 0.06), ('src3', 0.02), ('*', 0.74)),
d AS (SELECT *, CASE WHEN source IN ('src0', 'src1', 'src2', 'src3') THEN source ELSE '*' END AS s FROM documents),
n AS (SELECT s, count(*) AS n FROM d GROUP BY s),
rate AS (SELECT s, weight * (SELECT count(*) FROM d) / n AS rate FROM n JOIN w USING (s)),
cdf(s, rate, k, term, total) AS (
  SELECT s, rate, 0, exp(-rate), exp(-rate) FROM rate
  UNION ALL SELECT s, rate, k + 1, term * rate / (k + 1), total + term * rate / (k + 1) FROM cdf WHERE k < 80),
u AS (SELECT *, (('0x' || substr(md5('20:' || doc_id || ':0'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496 AS u FROM d),
c AS (SELECT u.doc_id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source,
             any_value(u.n_chars) AS n_chars, count(*) AS copies
      FROM u JOIN cdf ON u.s = cdf.s AND cdf.total < u.u GROUP BY u.doc_id),
x AS (SELECT doc_id, text, lang, source, n_chars, unnest(range(1, copies + 1))::INT AS copy FROM c)
SELECT *, substr(md5('20/' || doc_id || '/' || copy), 1, 16) AS shuffle_key FROM x
"""

ORACLE["op6_hamming_topk"] = r"""
WITH e AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: x > 0) AS b FROM embeddings),
p AS (SELECT q.vec_id AS query_id, e.vec_id AS neighbor_id,
             len(list_filter(list_zip(q.b, e.b), lambda z: z[1] <> z[2]))::INT AS distance
      FROM e q, e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id)
SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id)::INT AS rank
FROM p QUALIFY rank <= 10
"""

ORACLE["op10_repeats"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, len(w) AS n, unnest(range(1, greatest(len(w) - 48, 1))) AS i FROM d WHERE doc_id IS NOT NULL),
h AS (SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS low FROM h GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM h JOIN f USING (h) WHERE doc_id > low),
g AS (SELECT doc_id, list(p) AS gone FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(len(gone), 0) AS n_removed,
       sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(gone, i), false)), ' '), '')) AS kept_sha256
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""

ORACLE["op13_decontaminate"] = r"""
WITH i AS (SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
m AS (SELECT item, w, least(len(w), 10) AS m FROM i WHERE len(w) > 0),
s AS (SELECT DISTINCT item, m, array_to_string(w[k:k + m - 1], ' ') AS g
      FROM (SELECT item, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM m)),
x AS (SELECT doc_id, m, k, array_to_string(w[k:k + m - 1], ' ') AS g
      FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM d, (SELECT DISTINCT m FROM m) WHERE len(w) >= m)),
h AS (SELECT doc_id, x.m, k, item FROM x JOIN s ON x.g = s.g AND x.m = s.m),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(k, k + m)) AS p FROM h) GROUP BY doc_id),
n AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN p ON d.doc_id = p.doc_id LEFT JOIN n ON d.doc_id = n.doc_id
"""
