"""The named queries of this package, and the SQL twins of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from martloom.llm import (
    byte_bpe, centroids, embedding_forest, exact_dedup, hard_negatives, html_text, jaccard_join, kd_shards, language_id,
    packing, suffix_index, token_rollup, url_filter,
)
from martloom.llm.shipping import ship


def _table(name: str):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return read


documents, pages, embeddings, labels = (_table(name) for name in ("documents", "pages", "embeddings", "labels"))


# The rules of the site filter: later parts of this module's SQL state them again.
SITE_RULES = [
    url_filter.site_rule("net/", "block"), url_filter.site_rule("example.net/en/", "allow"),
    url_filter.site_rule("example.com/de/", "block"), url_filter.site_rule("org/fr/", "allow"),
]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(documents(spark, sf_dir))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.encode_texts(documents(spark, sf_dir), with_ids=False)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(pages(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op6_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards.shard(documents(spark, sf_dir))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(pages(spark, sf_dir), SITE_RULES)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), with_ids=False)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_rollup.corpus_rollup(documents(spark, sf_dir), labels(spark, sf_dir))


def op10_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_forest.near_vectors(embeddings(spark, sf_dir))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(embeddings(spark, sf_dir))


def op12_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_index.remove_repeats(documents(spark, sf_dir)).drop("spans")


def op13_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(embeddings(spark, sf_dir).withColumn("label", relabelled))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
        "op4_html_extraction": op4_html_extraction,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_kd_sharding": op6_kd_sharding,
        "op7_url_filters": op7_url_filters,
        "op8_packing": op8_packing,
        "op9_token_counts": op9_token_counts,
        "op10_embedding_near_dedup": op10_embedding_near_dedup,
        "op11_centroid_clustering": op11_centroid_clustering,
        "op12_suffix_array_dedup": op12_suffix_array_dedup,
        "op13_hard_negative_mining": op13_hard_negative_mining,
    }


OP5 = r"""
WITH rows AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM rows GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM rows JOIN groups USING (text_sha256)
"""

OP7 = r"""
WITH split AS (
    SELECT page_id,
        translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
judged AS (
    SELECT page_id, host, path, CASE
        WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/' END AS rule
    FROM split)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _op11() -> str:
    """Rounds of assignment and update as one CTE each."""
    steps = [f"""
points AS MATERIALIZED (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND {FINITE})""", """
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS k, v
    FROM points QUALIFY k < 40)"""]
    for r in range(6):
        steps.append(f"""
d{r} AS (
    SELECT vec_id, p.v, k, CAST(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v)
        + list_inner_product(c.v, c.v) AS BIGINT) AS distance FROM points p, c{r} c),
a{r} AS MATERIALIZED (
    SELECT vec_id, any_value(v) AS v, arg_min(k, distance * 64 + k) AS k, min(distance) AS distance
    FROM d{r} GROUP BY vec_id)""")
        if r < 5:
            steps.append(f"""
u{r} AS (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS nth FROM a{r}),
m{r} AS (SELECT k, nth, floor(sum(x) / count(*)) AS x FROM u{r} GROUP BY k, nth),
n{r} AS (SELECT k, list(x ORDER BY nth) AS v FROM m{r} GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT k, coalesce(n.v, c.v) AS v FROM c{r} c LEFT JOIN n{r} n USING (k))""")
    return "WITH " + ",".join(steps) + """
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, distance,
    CAST(sum(distance) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
    CAST(sum(distance) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(list_transform(c.v, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a5 a JOIN c5 c USING (k)
"""


OP12 = r"""
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS p FROM texts),
windows AS MATERIALIZED (SELECT doc_id, p, md5(substr(h, 2 * p + 1, 400)) AS w FROM starts),
twice AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
hits AS (SELECT doc_id, p FROM windows SEMI JOIN twice USING (w)),
marked AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 200, true) AS new FROM hits),
numbered AS (SELECT doc_id, p, sum(new::INT) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM marked),
spans AS (SELECT doc_id, min(p) AS low, max(p) + 200 AS high FROM numbered GROUP BY doc_id, span),
parts AS (
    SELECT doc_id, low, high, substr(h, 2 * since + 1, 2 * (low - since)) AS part FROM (
        SELECT *, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS since FROM spans)
    JOIN texts USING (doc_id)),
found AS (
    SELECT doc_id, string_agg(part, '' ORDER BY low) AS kept, max(high) AS last, sum(high - low) AS removed,
        count(*) AS n_spans FROM parts GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
    sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN found USING (doc_id)
"""

OP13 = f"""
WITH rows AS MATERIALIZED (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND {FINITE}),
scores AS MATERIALIZED (
    SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same, CAST(list_inner_product(a.v, r.v) AS BIGINT) AS score
    FROM rows a JOIN rows r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) <= 10
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op5_exact_dedup": OP5, "op7_url_filters": OP7, "op11_centroid_clustering": _op11(),
        "op12_suffix_array_dedup": OP12, "op13_hard_negative_mining": OP13}
