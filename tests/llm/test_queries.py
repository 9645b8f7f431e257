"""The registered queries on the smallest driver tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from check_oracle import rows
from gradeflow.llm import queries

FOLDER = "/root/testdata/sf0.001"
#: Query -> its columns, and the table that it has a row for each row of.
SHAPES = {
    "op1_html_extraction": ({"page_id", "url", "text", "n_chars"}, "pages"),
    "op2_line_quality": ({"doc_id", "held_out", "score", "predicted"}, "documents"),
    "op3_minhash_near_dedup": ({"doc_id", "n_shingles", "component_id", "kept"}, "documents"),
    "op4_exact_top_k": ({"query_id", "rank", "vec_id", "score"}, None),
    "op5_toxicity": ({"doc_id", "held_out", "score", "predicted", "evidence"}, "documents"),
    "op6_url_filter": ({"page_id", "host", "path", "rule", "verdict", "score"}, "pages"),
    "op7_word_bpe": ({"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}, "documents"),
    "op8_token_counts": ({"doc_id", "n_bytes", "n_tokens", "over_limit"}, "documents"),
    "op9_mixing_targets": ({"doc_id", "size", "source_size", "target", "taken"}, "documents"),
    "op10_nearest_neighbours": ({"query_id", "rank", "vec_id", "score"}, None),
    "op11_benchmark_passages": ({"doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"}, "documents"),
    "op12_prefix_trie": (
        {"conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"},
        None,
    ),
    "op13_ns_centroids": (
        {"vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"},
        "embeddings",
    ),
}


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", SHAPES)
def test_query(spark, con, name):
    columns, table = SHAPES[name]
    df = entry.queries()[name](spark, FOLDER)
    assert set(df.columns) == columns
    got = rows(df.columns, df.collect())
    if table:
        assert len(got) == con.execute(f"select count(*) from {table}").fetchone()[0]
    if name in queries.SQL:
        cursor = con.execute(queries.SQL[name])
        assert got == rows([d[0] for d in cursor.description], cursor.fetchall())


def test_all_are_registered():
    assert set(SHAPES) | {"pipeline"} <= set(entry.queries())
    assert set(queries.SQL) <= set(entry.oracle_sql())


def test_pipeline(spark):
    made = corpus_pipeline.run(spark, FOLDER)
    assert made.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert made.count() > 0
