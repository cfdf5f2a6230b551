"""The registered queries of the operators, over whole tables, and their DuckDB statements."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    align,
    bpe,
    chat,
    extract,
    knn,
    language,
    packing,
    pii,
    piecewise,
    sharding,
    simhash,
    url_filter,
    variants,
)
from .shared import table

#: Vocabulary files; the operators take any.
WORDS = public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def op1_weighted_hash_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


def op2_host_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages"))


def op3_bin_completion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), WORDS)


def op4_two_tier_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op5_simhash_bk_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_voronoi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return knn.top_k(table(spark, sf_dir, "embeddings"))


def op7_nearest_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn(docs)
    return language.classify(docs.select("doc_id", "text"), model).select(
        "doc_id",
        language.held_out(F.col("doc_id")).alias("held_out"),
        "lang_pred",
        "score",
        "rejected",
    )


def op8_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.replace(docs).select("doc_id", "text", "entities")


def op9_piecewise_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piecewise.fingerprints(table(spark, sf_dir, "documents"))


def op10_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages"))


def op11_bisected_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.alignment(table(spark, sf_dir, "documents"), BYTES, PIECES)


def op12_template_compiler(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(F.lit(-7).alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), said.alias("text"))
    return chat.formatted_digests(conversations.unionByName(probe))


def op13_sorted_list_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group_variants(table(spark, sf_dir, "documents"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_weighted_hash_tree,
        op2_host_suffix_array,
        op3_bin_completion,
        op4_two_tier_bpe,
        op5_simhash_bk_trees,
        op6_voronoi_join,
        op7_nearest_centroids,
        op8_surrogates,
        op9_piecewise_hashing,
        op10_bloom_cascade,
        op11_bisected_alignment,
        op12_template_compiler,
        op13_sorted_list_edits,
    )
}

ORACLE_SQL = {
    "op6_voronoi_join": """
WITH whole AS (
    SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, d.vec_id AS vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM whole q JOIN whole d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scores
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
""",
    "op10_bloom_cascade": r"""
WITH rules(verdict, host, path) AS (
    VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
           ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
    FROM rest
), best AS (
    SELECT p.page_id, p.host, p.path, r.host || r.path AS rule, r.verdict,
           row_number() OVER (PARTITION BY p.page_id
                              ORDER BY length(r.host || r.path) DESC, length(r.host) DESC) AS place
    FROM parts p LEFT JOIN rules r
      ON (p.host = r.host OR suffix(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM best WHERE place = 1
""",
    "op12_template_compiler": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL
    VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), escaped AS (
    SELECT *,
        replace(replace(replace(replace(replace(replace(replace(text, '\', '\\'), '[INST]', '\a'),
            '[/INST]', '\b'), '<s>', '\c'), '</s>', '\d'), '[TURN]', '\e'), '[/TURN]', '\f') AS out_text,
        replace(replace(replace(replace(replace(replace(replace(replace(role, '\', '\\'), '[INST]', '\a'),
            '[/INST]', '\b'), '<s>', '\c'), '</s>', '\d'), '[TURN]', '\e'), '[/TURN]', '\f'), chr(10), '\g') AS out_role
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(out_text) + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 7 ELSE 16 + length(out_role) END)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
""",
}
