"""Exact top-k inner products by distributed histogram selection.

All candidates are scored against all queries, block against block.  No scores are
kept: each round sums, over all blocks, how many scores of a query fall into each bin
of the range that holds its k-th best score, and the next round splits that bin, until
a bin is one score.  Then only scores from the k-th best up are written, and ties at it
are broken by the smaller id.

From a block, only the best bins that hold k scores of it count: lower ones can't hold
the k-th best of all.  So a round sends at most k numbers per query and block.

Blocks of candidates stay where they were written and are neither copied nor shuffled.
Blocks of queries are sent to them, so many at a time as ``SENT_BYTES`` hold.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.llm.common import landed
from gradeflow.llm.vectors import (
    BLOCK,
    QUERY_BLOCK,
    blocks,
    matrix,
    numbers,
    queries_of,
    same_width,
    structs_of,
    usable,
)

#: Width of the bins of each round, as powers of two; the last is one score.
SHIFTS = (16, 8, 0)
#: Bytes of queries that are sent to every executor at once, through the driver.
SENT_BYTES = 16 * 1024 * 1024
#: Bytes of a query besides its components.
QUERY_BYTES = 128


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products; in 64-bit integers where doubles would not be exact."""
    a, b = same_width(a, b)
    largest = np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1])
    if largest < 2**53:
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best_bins(bins: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """The highest bins that hold ``need`` of the values, and their counts."""
    if len(bins) > need:
        bins = bins[bins >= np.partition(bins, len(bins) - need)[len(bins) - need]]
    return np.unique(bins, return_counts=True)


def histogram(width: int | None, shift: int):
    """Counts by bin of ``shift`` bits inside each query's bin of ``width`` bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from one(structs_of(batch, "v", row), structs_of(batch, "q", row))

    def one(v: pa.StructArray, q: pa.StructArray) -> Iterator[pa.RecordBatch]:
        got = scores(matrix(q, "vec"), matrix(v, "vec"))
        ids, vids = numbers(q, "vec_id"), numbers(v, "vec_id")
        bins, needs = numbers(q, "bin"), numbers(q, "need")
        out: list[tuple] = []
        for i, query in enumerate(ids):
            mine = got[i][vids != query]
            if width is not None:
                mine = mine[(mine >> width) == bins[i]]
            if len(mine):
                best, counts = best_bins(mine >> shift, int(needs[i]))
                out.append((np.full(len(best), query), best, counts))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], ["query_id", "bin", "n"]
            )

    return run


def candidates(k: int):
    """Scores above the k-th best, and the k smallest ids of a block that tie with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from one(structs_of(batch, "v", row), structs_of(batch, "q", row))

    def one(v: pa.StructArray, q: pa.StructArray) -> Iterator[pa.RecordBatch]:
        got = scores(matrix(q, "vec"), matrix(v, "vec"))
        ids, vids = numbers(q, "vec_id"), numbers(v, "vec_id")
        least, whole = numbers(q, "bin"), numbers(q, "whole")
        out: list[tuple] = []
        for i, query in enumerate(ids):
            keep = np.flatnonzero((vids != query) & (whole[i] | (got[i] >= least[i])))
            order = np.lexsort((vids[keep], -got[i][keep]))[:k]
            keep = keep[order]
            out.append((np.full(len(keep), query), vids[keep], got[i][keep]))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*out)], ["query_id", "vec_id", "score"]
            )

    return run


def top_k(
    vectors: DataFrame,
    k: int = 5,
    modulus: int = 50,
    scale: float = 256.0,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k best inner products.

    A component x counts as floor(scale * x).  Queries are the ids divisible by
    ``modulus``; candidates are all rows with another id.  Rows without an id, a vector,
    or with a component that is null or not finite take no part; a vector without
    components, or shorter than another, goes on with zeros.  Repeated rows are
    candidates each; a repeated query is one.  Ties go to the smaller id.  An empty table
    gives no rows.  Scores must fit 64 bits.
    """
    rows = usable(vectors, id_column, vector_column)
    vec = F.transform("vec", lambda x: F.floor(x * F.lit(scale)).cast("double"))
    rows = landed(rows.select("vec_id", vec.alias("vec")))
    count = max(1, -(-rows.count() // BLOCK))
    base = landed(blocks(rows, "vb", count, ["vec_id", "vec"]).withColumnRenamed("rows", "v"))
    asked = landed(queries_of(rows, modulus))
    size = F.sum(F.size("vec") * 8 + QUERY_BYTES)
    queries, sent = asked.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    # Queries are independent, so that those sent at once are settled before the next.
    turns = max(1, -(-sent // SENT_BYTES))
    query_blocks = max(1, -(-queries // (turns * QUERY_BLOCK)))
    turn = F.pmod(F.xxhash64("vec_id"), F.lit(turns))
    parts = [landed(_settled(base, asked.filter(turn == n), query_blocks, k)) for n in range(turns)]
    return reduce(DataFrame.unionByName, parts)


def _settled(base: DataFrame, asked: DataFrame, query_blocks: int, k: int) -> DataFrame:
    """query_id, rank, vec_id, score of the queries ``asked`` over all blocks of candidates."""
    state = asked.select(
        "*",
        F.lit(0).cast("long").alias("bin"),
        F.lit(k).cast("long").alias("need"),
        F.lit(False).alias("whole"),
    )

    def grid(state: DataFrame) -> DataFrame:
        fields = ["vec_id", "vec", "bin", "need", "whole"]
        sent = blocks(state, "qb", query_blocks, fields).select(F.col("rows").alias("q"))
        return base.crossJoin(F.broadcast(sent)).select("v", "q")

    width = None
    for shift in SHIFTS:
        made = grid(state).mapInArrow(histogram(width, shift), "query_id long, bin long, n long")
        counts = made.groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        down = Window.partitionBy("query_id").orderBy(F.col("bin").desc())
        upto = counts.withColumn("upto", F.sum("n").over(down)).alias("h")
        # The bin that holds the k-th best; a query without it takes all its candidates.
        found = upto.join(state.select("vec_id", "need").alias("s"), F.col("query_id") == F.col("s.vec_id"))
        found = found.filter((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        found = found.select("query_id", F.col("h.bin").alias("bin"), (F.col("need") - F.col("upto") + F.col("n")).alias("need"))
        joined = asked.join(found, F.col("vec_id") == F.col("query_id"), "left")
        state = landed(
            joined.select(
                "vec_id",
                "vec",
                F.coalesce("bin", F.lit(-(2**62))).alias("bin"),
                F.coalesce("need", F.lit(k)).alias("need"),
                F.col("bin").isNull().alias("whole"),
            )
        )
        width = shift
    kept = grid(state).mapInArrow(candidates(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = kept.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS c
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, v.vec_id,
         coalesce(list_sum(list_transform(list_zip(q.c, v.c), lambda z: z[1] * z[2])), 0)::BIGINT AS score
  FROM v AS q JOIN v ON v.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 5
"""
