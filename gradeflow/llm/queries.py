"""The registered queries of the operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gradeflow.llm import (
    bpe,
    centroids,
    decontamination,
    exact_topk,
    html_extraction,
    mixing,
    near_dedup,
    neighbours,
    prefix_trie,
    quality,
    token_counts,
    toxicity,
    urls,
)
from gradeflow.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk.top_k(table(spark, sf_dir, "embeddings"))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(table(spark, sf_dir, "pages"))


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def document_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def toxic_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = urls.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def piece_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path)


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def benchmark_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))


def centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))


def shipped(query: Query) -> Query:
    """The query after the workers got this package."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_html_extraction": page_text,
    "op2_line_quality": document_quality,
    "op3_minhash_near_dedup": near_duplicates,
    "op4_exact_top_k": exact_top_k,
    "op5_toxicity": toxic_documents,
    "op6_url_filter": url_filter,
    "op7_word_bpe": word_bpe,
    "op8_token_counts": piece_token_counts,
    "op9_mixing_targets": mixing_targets,
    "op10_nearest_neighbours": nearest_neighbours,
    "op12_prefix_trie": conversation_trie,
    "op13_ns_centroids": centroid_clusters,
}
#: Made of DataFrame functions alone: nothing to send to Python workers.
_NATIVE: dict[str, Query] = {"op11_benchmark_passages": benchmark_passages}

QUERIES = {name: shipped(query) for name, query in _QUERIES.items()} | _NATIVE

#: Every two classes of equal sets that share a shingle are compared; what links reach is followed
#: step by step.
NEAR_DUPLICATES_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
), sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 2),
            lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3]))) END AS s
    FROM words
), classes AS MATERIALIZED (
    SELECT min(doc_id) AS class, s, len(s) AS n FROM sets WHERE len(s) > 0 GROUP BY s
), shingles AS MATERIALIZED (
    SELECT class, n, unnest(s) AS shingle FROM classes
), links AS MATERIALIZED (
    SELECT a.class AS x, b.class AS y FROM shingles a JOIN shingles b
        ON a.shingle = b.shingle AND a.class < b.class
        -- Sets of too different sizes are never that similar.
        AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
    GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), edges AS MATERIALIZED (
    SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached(class, node) AS (
    SELECT class, class FROM classes
    UNION
    SELECT r.class, e.y FROM reached r JOIN edges e ON r.node = e.x
), roots AS (
    SELECT class, min(node) AS root FROM reached GROUP BY class
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(r.root, d.doc_id) AS component_id,
    d.doc_id = coalesce(r.root, d.doc_id) AS kept
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN roots r ON c.class = r.class
"""

SQL: dict[str, str] = {
    "op3_minhash_near_dedup": NEAR_DUPLICATES_SQL,
    "op4_exact_top_k": exact_topk.TOPK_SQL,
    "op9_mixing_targets": mixing.MIX_SQL,
    "op11_benchmark_passages": decontamination.CONTAMINATION_SQL,
    "op12_prefix_trie": prefix_trie.TRIE_SQL,
    "op13_ns_centroids": centroids.CLUSTER_SQL,
}
