"""Approximate nearest neighbours with learned partitions.

On a bounded sample, the graph of nearest neighbours is cut into balanced parts, and a
small network learns in which parts a vector's neighbours lie.  Every vector goes to its
most probable part.  A query goes to as many of its most probable parts as held the
wanted share of neighbours of sampled vectors that were kept from learning, and to more
where these hold too few other vectors.  The vectors of its parts are ranked by their
exact distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.llm import partitions
from gradeflow.llm.common import in_share, landed
from gradeflow.llm.vectors import (
    BLOCK,
    QUERY_BLOCK,
    matrix,
    numbers,
    queries_of,
    same_width,
    structs_of,
    usable,
)

#: Vectors to learn from, at most about this many; one in HOLD is kept from learning.
SAMPLE, HOLD = 4096, 4
#: Parts at least, vectors of the table for each part beyond, least vectors of the sample for each:
#: so a query visits a share of a table, and more parts than the sample can tell apart are not made.
PARTS, PART_ROWS, LEAST = 16, 2048, 16
#: Share of the neighbours that the visited parts hold in the sample.
RECALL = 0.95
#: Components beyond this are scaled down before they are squared.
HUGE = 1e150


class Routes:
    """The router with the number of parts to visit; vectors of another width end in zeros."""

    def __init__(self, sample: np.ndarray, parts: int, k: int, recall: float):
        self.width = sample.shape[1]
        kept = np.arange(len(sample)) % HOLD == 0
        self.parts = max(1, min(parts, (~kept).sum() // LEAST)) if len(sample) else 1
        self.router, self.probes = None, 1
        if self.parts > 1:
            self.router = partitions.learn(sample[~kept], self.parts)
            self.probes = partitions.probes_for(self.router, sample[~kept], sample[kept], self.parts, k, recall)

    def probable(self, vectors: np.ndarray, count: int) -> np.ndarray:
        if self.router is None:
            return np.zeros((len(vectors), 1), np.int64)
        if vectors.shape[1] != self.width:
            wide = np.zeros((len(vectors), self.width))
            width = min(self.width, vectors.shape[1])
            wide[:, :width] = vectors[:, :width]
            vectors = wide
        return self.router.probable(vectors, count)


def fitted(rows: DataFrame, sample: int, parts: int | None, k: int, recall: float) -> Routes:
    """``parts`` is by the number of rows unless it is given."""
    size = rows.count()
    # Equal vectors teach nothing new: each counts once.
    chosen = rows.filter(in_share(sample / max(1, size), "vec_id", "vec")).groupBy("vec").agg(F.min("vec_id").alias("vec_id"))
    table = chosen.orderBy(F.xxhash64("vec"), "vec_id").toArrow().combine_chunks()
    structs = pa.StructArray.from_arrays([table.column("vec").combine_chunks()], ["vec"])
    return Routes(matrix(structs, "vec"), parts or max(PARTS, size // PART_ROWS), k, recall)


def routed(rows: DataFrame, routes: Routes, held: list[int] | None = None, k: int = 0) -> DataFrame:
    """vec_id, vec, part: a vector's most probable part, or with ``held`` the parts a query visits.

    ``held`` is how many vectors each part holds.  A query goes to parts until they hold
    ``k`` vectors besides its ``own`` ones.
    """
    shared = rows.sparkSession.sparkContext.broadcast((routes, None if held is None else np.array(held)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        routes, held = shared.value
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                part = pa.RecordBatch.from_arrays([pa.concat_arrays([c]) for c in part.columns], part.schema.names)
                vectors = matrix(pa.StructArray.from_arrays([part.column(1)], ["vec"]), "vec")
                found = routes.probable(vectors, 1 if held is None else routes.parts)
                visited = np.ones(len(found), np.int64)
                if held is not None:
                    enough = np.cumsum(held[found], axis=1) >= k + part.column(2).to_numpy()[:, None]
                    first = np.where(enough.any(axis=1), enough.argmax(axis=1) + 1, found.shape[1])
                    visited = np.maximum(first, min(routes.probes, found.shape[1]))
                take = pa.array(np.repeat(np.arange(len(found)), visited))
                chosen = found[np.arange(found.shape[1]) < visited[:, None]]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array(chosen, pa.int64())],
                    ["vec_id", "vec", "part"],
                )

    columns = ["vec_id", "vec"] if held is None else ["vec_id", "vec", "own"]
    return rows.select(*columns).mapInArrow(run, "vec_id long, vec array<double>, part long")


def dealt(rows: DataFrame, name: str, other: str, own: list[int], across: list[int], cell: str) -> DataFrame:
    """Blocks of each part, a row for every block of the other side: part, both numbers, the cell."""
    counts = F.array(*[F.lit(n) for n in own])
    others = F.array(*[F.lit(n) for n in across])
    at = (F.col("part") + 1).cast("int")
    # Dealt by position, so that no vector that many rows share fills a block.
    block = F.pmod(F.monotonically_increasing_id(), F.element_at(counts, at)).cast("int")
    made = rows.withColumn(name, block).groupBy("part", name).agg(F.collect_list(F.struct("vec_id", "vec")).alias(cell))
    last = F.element_at(others, at) - 1
    return made.filter(last >= 0).select("*", F.explode(F.sequence(F.lit(0), last)).alias(other))


def ranked(k: int):
    """The k nearest of a block of vectors for each query of a block, by exact distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield from one(structs_of(batch, "v", row), structs_of(batch, "q", row))

    def one(v: pa.StructArray, q: pa.StructArray) -> Iterator[pa.RecordBatch]:
        queries, vectors = same_width(matrix(q, "vec"), matrix(v, "vec"))
        qids, vids = numbers(q, "vec_id"), numbers(v, "vec_id")
        largest = max(np.abs(queries).max(initial=0), np.abs(vectors).max(initial=0))
        scale = largest if largest > HUGE else 1.0
        queries, vectors = queries / scale, vectors / scale
        own, norms = (queries * queries).sum(axis=1), (vectors * vectors).sum(axis=1)
        squares = own[:, None] + norms - 2 * (queries @ vectors.T)
        # More than what rounding can change in a square.
        slack = 1e-9 * (own + norms.max(initial=0)) + 1e-300
        out: list[tuple] = []
        for i, query in enumerate(qids):
            near = squares[i]
            near[vids == query] = np.inf
            rows = np.flatnonzero(near < np.inf)
            if len(rows) > k:
                rows = rows[near[rows] <= np.partition(near[rows], k - 1)[k - 1] + slack[i]]
            exact = np.sqrt(((vectors[rows] - queries[i]) ** 2).sum(axis=1))
            order = np.lexsort((vids[rows], exact))[:k]
            out.append((np.full(len(order), query), vids[rows][order], exact[order] * scale))
        if out:
            ids, found, scores = (np.concatenate(x) for x in zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.astype(np.int64)), pa.array(found.astype(np.int64)), pa.array(scores.astype(np.float64))],
                ["query_id", "vec_id", "score"],
            )

    return run


def nearest(
    vectors: DataFrame,
    k: int = 10,
    modulus: int = 100,
    parts: int | None = None,
    sample: int = SAMPLE,
    recall: float = RECALL,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k nearest vectors found.

    Queries are the ids divisible by ``modulus``; candidates are all rows with another id;
    ``score`` is the Euclidean distance.  Rows without an id, a vector, or with only zeros
    or a component that is null or not finite take no part; shorter vectors go on with
    zeros.  Repeated rows are candidates each; a repeated query is one.  Ties go to the
    smaller id.  A distance beyond what a double holds is infinite.  An empty table gives
    no rows; every query gets ``k`` rows if the table has that many other vectors.
    """
    rows = landed(usable(vectors, id_column, vector_column, zero=False))
    routes = fitted(rows, sample, parts, k, recall)
    index = landed(routed(rows, routes))

    def sizes(side: DataFrame) -> list[int]:
        found = {r.part: r["count"] for r in side.groupBy("part").count().collect()}
        return [found.get(part, 0) for part in range(routes.parts)]

    held = sizes(index)
    own = rows.filter(F.col("vec_id") % modulus == 0).groupBy("vec_id").agg(F.count("*").alias("own"))
    asked = landed(routed(queries_of(rows, modulus).join(own, "vec_id"), routes, held, k))
    blocks = [-(-n // BLOCK) for n in held]
    query_blocks = [-(-n // QUERY_BLOCK) for n in sizes(asked)]
    left = dealt(asked, "qb", "vb", query_blocks, blocks, "q")
    right = dealt(index, "vb", "qb", blocks, query_blocks, "v")
    made = left.join(right, ["part", "vb", "qb"]).select("v", "q").mapInArrow(
        ranked(k), "query_id long, vec_id long, score double"
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    best = made.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return best.select("query_id", "rank", "vec_id", "score")
