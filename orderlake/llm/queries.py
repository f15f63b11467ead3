"""The registered corpus queries and, where SQL can state the result, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm import (block_kmeans, hard_negatives, lm_scoring, minmax_dedup, packing, permutation_index,
                           personal_data, piece_viterbi, quality, substring_dedup, toxicity, url_filter, vector_dedup)
from orderlake.llm.corpus import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(make: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[make.__name__] = make
    return make


@query
def op1_lm_scoring(spark, sf_dir):
    """Base and model scores of every text."""
    return lm_scoring.scores(table(spark, sf_dir, "documents"))


@query
def op2_toxicity(spark, sf_dir):
    """Toxicity score of every text."""
    return toxicity.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_url_filter(spark, sf_dir):
    """Verdict of every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


@query
def op4_permutation_index(spark, sf_dir):
    """The 20 nearest of every twentieth vector, against all vectors."""
    return permutation_index.nearest(table(spark, sf_dir, "embeddings"))


@query
def op5_quality(spark, sf_dir):
    """Quality score of every text."""
    return quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_substring_dedup(spark, sf_dir):
    """Word spans of all documents that repeat a passage which another document keeps."""
    return substring_dedup.removals(table(spark, sf_dir, "documents"))


@query
def op7_vector_dedup(spark, sf_dir):
    """Links, component and decision of every vector at cosine 0.98 within its label."""
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op8_piece_coding(spark, sf_dir):
    """Digest of encoding and decoding every text."""
    return piece_viterbi.coding_digest(table(spark, sf_dir, "documents"))


@query
def op9_packing(spark, sf_dir):
    """Every piece of every document in sequences of 2048 ids."""
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op10_minmax_dedup(spark, sf_dir):
    """Near-duplicate classes of all documents: three-word shingles, similarity 0.85."""
    return minmax_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)


@query
def op11_centroid_clustering(spark, sf_dir):
    """Cluster of every vector after five rounds from 40 hashed starts."""
    return block_kmeans.cluster_report(table(spark, sf_dir, "embeddings"))


@query
def op12_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector and its positives, against all vectors."""
    rows = table(spark, sf_dir, "embeddings")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(rows.select("vec_id", "embedding", turned.alias("label")), F.col("id") % 100 == 0)


@query
def op13_personal_data(spark, sf_dir):
    """Personal data spans of every whole text."""
    return personal_data.report(table(spark, sf_dir, "documents"))


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = f"""array_to_string(list_transform(
    regexp_extract_all({_LOWER.format("coalesce(url, '')")}, '%[2-7][0-9a-f]|[^%]+|%'),
    lambda t: CASE WHEN regexp_full_match(t, '%[2-7][0-9a-f]') THEN chr(CAST('0x' || substr(t, 2) AS INTEGER)) ELSE t END), '')"""

ORACLE_SQL["op3_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, string_split_regex({_LOWER.format(_PLAIN)}, '[^\\p{{L}}\\p{{M}}\\p{{N}}]') AS tokens,
    CASE WHEN contains(coalesce(url, ''), '://')
         THEN translate(regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN contains(coalesce(url, ''), '://')
         THEN regexp_extract(url, '^.*?://([^/?#]*)([^?#]*)', 2, 's') ELSE '' END AS path
  FROM pages),
rules(verdict, rule) AS (VALUES {", ".join(f"('{v}', '{r}')" for v, r in url_filter.RULES)}),
soft(term, weight) AS (VALUES {", ".join(f"('{t}', {w})" for t, w in url_filter.SOFT.items())}),
judged AS (
  SELECT *, (SELECT max_by(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule)) FROM rules r
     WHERE (host = split_part(r.rule, '/', 1) OR ends_with(host, '.' || split_part(r.rule, '/', 1)))
       AND starts_with(path, substr(r.rule, strpos(r.rule, '/')))) AS best,
    CAST(len(list_filter(tokens, lambda t: list_contains([{", ".join(f"'{t}'" for t in url_filter.STRICT)}], t)))
         AS INTEGER) AS strict_hits,
    coalesce((SELECT sum(weight) FROM soft WHERE list_contains(tokens, term)), 0)::DOUBLE AS soft_weight
  FROM parts)
SELECT page_id, host, path, best.rule AS rule,
  CASE WHEN best IS NOT NULL THEN best.verdict
       WHEN strict_hits > 0 OR soft_weight >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict,
  strict_hits, soft_weight
FROM judged"""

ORACLE_SQL["op10_minmax_dedup"] = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'),
                             lambda w: w <> '') AS ws FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END) AS items
  FROM split),
flat AS (SELECT doc_id, len(items) AS n, unnest(items) AS item FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.item = b.item AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 85 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (
  SELECT doc_id, doc_id FROM sets UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles, min(b) AS component_id, doc_id = min(b) AS kept
FROM sets JOIN reach ON doc_id = a GROUP BY doc_id, items"""

ORACLE_SQL["op7_vector_dedup"] = """
WITH RECURSIVE good AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_inner_product(a.v, b.v) / sqrt(list_inner_product(a.v, a.v) * list_inner_product(b.v, b.v)) >= 0.98),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE links.a = vec_id) AS n_links, min(b) AS component_id,
  vec_id = min(b) AS kept
FROM embeddings JOIN reach ON vec_id = a GROUP BY vec_id"""


def _round(n: int) -> str:
    """Assignment to the centroids of round ``n``, and the centroids after it, as common table expressions."""
    return f"""near{n} AS MATERIALIZED (
  SELECT p.row, arg_min(c.cluster, (p.norm + c.norm - 2 * CAST(list_inner_product(p.v, c.v) AS HUGEINT), c.cluster)) AS cluster,
    min(p.norm + c.norm - 2 * CAST(list_inner_product(p.v, c.v) AS HUGEINT)) AS distance
  FROM points p CROSS JOIN centres{n} c GROUP BY p.row),
means{n} AS (
  SELECT cluster, i, floor(sum(x) / count(*)) AS x
  FROM (SELECT n.cluster, unnest(p.v) AS x, unnest(range(1, 65)) AS i FROM near{n} n JOIN points p ON p.row = n.row)
  GROUP BY cluster, i),
moved{n} AS (SELECT cluster, list(x ORDER BY i) AS v FROM means{n} GROUP BY cluster),
centres{n + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(m.v, c.v) AS v, list_inner_product(coalesce(m.v, c.v), coalesce(m.v, c.v)) AS norm
  FROM centres{n} c LEFT JOIN moved{n} m ON m.cluster = c.cluster)"""


ORACLE_SQL["op11_centroid_clustering"] = f"""
WITH good AS MATERIALIZED (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
points AS MATERIALIZED (SELECT *, list_inner_product(v, v) AS norm FROM good),
centres0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS cluster, v, norm
  FROM points WHERE vec_id IS NOT NULL QUALIFY cluster < 40),
{", ".join(_round(n) for n in range(6))},
names AS (
  SELECT cluster, sha256(array_to_string(list_transform(v, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ',')) AS name
  FROM centres5)
SELECT vec_id, near5.cluster, CAST(distance AS BIGINT) AS distance,
  CAST(sum(distance) OVER (PARTITION BY near5.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, name AS centroid_sha256
FROM near5 JOIN points ON points.row = near5.row JOIN names ON names.cluster = near5.cluster"""

ORACLE_SQL["op12_hard_negatives"] = """
WITH good AS MATERIALIZED (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS MATERIALIZED (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM good a JOIN good b ON a.id <> b.id WHERE a.id % 100 = 0),
positives AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.positive_id,
  CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
  s.id AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
QUALIFY rank <= 10"""
