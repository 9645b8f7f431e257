"""Centroid clustering with ns-bounds: exact rounds of Lloyd's algorithm, few distances.

Every vector keeps its cluster, and for each centroid the distance at some earlier round with
that round's number.  All centroids of all rounds are retained, so a stored distance is
loosened by the norm of the centroid's whole displacement since then, which is never more than
the sum of its steps.  Only centroids whose loosened bound reaches below the vector's own upper
bound are measured again, in whole numbers, so the clusters are those of the plain algorithm.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import landed

DIMENSIONS = 64
CENTROIDS, ROUNDS = 16, 3
#: Components become whole numbers of this part.
SCALE = 64
#: What the first centroids are chosen by, before the id.
SEED = "1:"
#: Largest whole component: squared distances then fit 64 bits.
LARGEST = 1 << 27
#: Vectors whose sums a task adds up at a time.
SLICE = 1 << 14
#: Bounds are kept in 32 bits; this share of them is more than what rounding takes.
SLACK = 1e-6

STATE = "vec_id long, x array<int>, cluster int, seen array<float>, rounds binary"


def whole(vectors: DataFrame) -> DataFrame:
    """vec_id, x of every vector of ``DIMENSIONS`` finite components, as whole numbers.

    A component whose whole number is beyond ``LARGEST`` is an error: distances between such
    vectors may not fit the result.
    """
    vec = F.col("embedding").cast("array<double>")
    infinite = float("inf")
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (x < infinite) & (x > -infinite))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), vec.alias("vec"))
    rows = rows.filter(F.size("vec") == DIMENSIONS).filter(finite)
    scaled = F.transform("vec", lambda x: x * SCALE)
    fits = F.forall("vec", lambda x: F.abs(x) <= LARGEST // SCALE)
    error = F.raise_error(F.lit(f"a component of more than {LARGEST // SCALE} has no exact distance in 64 bits"))
    x = F.when(fits, F.transform(scaled, lambda v: F.floor(v).cast("int"))).otherwise(error.cast("array<int>"))
    return rows.select("vec_id", x.alias("x"))


def first_centroids(rows: DataFrame, count: int, seed: str = SEED) -> np.ndarray:
    """The vectors of the smallest hashes of their ids, ties by components; a null id is an empty one."""
    name = F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    chosen = rows.select(F.sha2(name, 256).alias("hash"), "x").orderBy("hash", "x").limit(count).collect()
    return np.array([r.x for r in chosen], dtype=np.int64).reshape(-1, DIMENSIONS)


def squared(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid, or to one each."""
    difference = x - centroid
    return np.einsum("ij,ij->i", difference, difference)


def moved(history: list[np.ndarray]) -> np.ndarray:
    """(round, centroid): how far each centroid is now from where it was in that round."""
    steps = np.array(history, dtype=np.float64) - history[-1]
    return np.sqrt((steps * steps).sum(axis=2))


def assign(
    x: np.ndarray, cluster: np.ndarray, seen: np.ndarray, rounds: np.ndarray, history: list[np.ndarray]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Nearest centroids, ties to the smaller number, with new bounds and how many distances it took.

    ``seen[i, j]`` is the distance of vector i to centroid j in round ``rounds[i, j]``, rounded to 32
    bits; ``cluster`` is -1 where there are none yet.
    """
    now, centroids = len(history) - 1, history[-1]
    count, asked = len(centroids), 0
    cluster, seen, rounds = cluster.copy(), seen.copy(), rounds.copy()
    new = cluster < 0
    best = np.zeros(len(x), dtype=np.int64)

    def measure(rows: np.ndarray, j: int) -> np.ndarray:
        nonlocal asked
        asked += len(rows)
        exact = squared(x[rows], centroids[j])
        seen[rows, j] = np.sqrt(exact)
        rounds[rows, j] = now
        return exact

    if new.any():
        rows = np.flatnonzero(new)
        exact = np.stack([measure(rows, j) for j in range(count)], axis=1)
        cluster[rows] = exact.argmin(axis=1)
        best[rows] = exact.min(axis=1)
    old = np.flatnonzero(~new)
    if not len(old):
        return cluster, seen, rounds, asked
    far = moved(history)
    numbers = np.arange(count)
    drift = far[rounds[old], numbers]
    lower = seen[old] * (1 - SLACK) - drift * (1 + SLACK)
    own = cluster[old].copy()
    at = np.arange(len(old))
    upper = seen[old, own] * (1 + SLACK) + drift[at, own] * (1 + SLACK)
    lower[at, own] = np.inf
    # Where some bound is reached, the own centroid is measured first; often that is enough.
    loose = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    nearest = np.full(len(old), -1, dtype=np.int64)
    for j in numbers:
        of = loose[own[loose] == j]
        nearest[of] = measure(old[of], j)
    upper[loose] = np.sqrt(nearest[loose]) * (1 + SLACK)
    for j in numbers:
        of = loose[(own[loose] != j) & (lower[loose, j] <= upper[loose])]
        exact = measure(old[of], j)
        current = cluster[old[of]]
        closer = (exact < nearest[of]) | ((exact == nearest[of]) & (j < current))
        changed = of[closer]
        nearest[changed] = exact[closer]
        cluster[old[changed]] = j
        upper[changed] = np.sqrt(nearest[changed]) * (1 + SLACK)
    return cluster, seen, rounds, asked


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def step(rows: DataFrame, history: list[np.ndarray]) -> DataFrame:
    """The rows with their state after one more assignment to the last of ``history``; written."""
    known = rows.sparkSession.sparkContext.broadcast(history)
    first, count = len(history) == 1, len(history[-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.num_rows
            x = _matrix(batch.column(1), DIMENSIONS, np.int64)
            if first:
                cluster = np.full(size, -1)
                seen, rounds = np.zeros((size, count), np.float32), np.zeros((size, count), np.uint8)
            else:
                cluster = batch.column(2).to_numpy().astype(np.int64)
                seen = _matrix(batch.column(3), count, np.float32)
                rounds = np.frombuffer(b"".join(batch.column(4).to_pylist()), np.uint8).reshape(size, count)
            cluster, seen, rounds, _ = assign(x, cluster, seen, rounds, known.value)
            offsets = pa.array(np.arange(size + 1, dtype=np.int32) * count)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(cluster.astype(np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(seen.ravel())),
                    pa.array([row.tobytes() for row in rounds], pa.binary()),
                ],
                ["vec_id", "x", "cluster", "seen", "rounds"],
            )

    return landed(rows.mapInArrow(run, STATE))


def sums(state: DataFrame) -> DataFrame:
    """cluster, rows, at, total: how many vectors each cluster has, and the sum of each component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        added: dict[int, list] = {}
        for batch in batches:
            x = _matrix(batch.column(1), DIMENSIONS, np.int64)
            cluster = batch.column(0).to_numpy()
            for start in range(0, len(x), SLICE):
                part, of = x[start : start + SLICE], cluster[start : start + SLICE]
                for j in np.unique(of):
                    held = added.setdefault(int(j), [0, [0] * DIMENSIONS])
                    held[0] += int((of == j).sum())
                    held[1] = [a + b for a, b in zip(held[1], part[of == j].sum(axis=0).tolist())]
        out = [(j, n, at, total) for j, (n, totals) in added.items() for at, total in enumerate(totals)]
        columns = zip(*out) if out else ([], [], [], [])
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["cluster", "rows", "at", "total"])

    parts = state.select("cluster", "x").mapInArrow(run, "cluster int, rows long, at int, total long")
    return parts.groupBy("cluster", "at").agg(F.sum("rows").alias("rows"), F.sum("total").alias("total"))


def means(state: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Centroids at the floor of their vectors' exact means; those without vectors stay.

    A number for each component of each centroid reaches the driver.
    """
    out = centroids.copy()
    for row in sums(state).collect():
        out[row.cluster, row.at] = row.total // row.rows
    return out


def _distances(state: DataFrame, centroids: np.ndarray) -> DataFrame:
    known = state.sparkSession.sparkContext.broadcast(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1), DIMENSIONS, np.int64)
            cluster = batch.column(2).to_numpy()
            exact = squared(x, known.value[cluster])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(exact)], ["vec_id", "cluster", "distance"]
            )

    rows = state.select("vec_id", "x", "cluster")
    return landed(rows.mapInArrow(run, "vec_id long, cluster int, distance long"))


def name_of(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, count: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector.

    Vectors that are null, not of ``DIMENSIONS`` components or hold a null or non-finite one are left
    out.  Repeated rows and ids are vectors of their own; a null id is kept, and counts as
    empty where ids are hashed.  With fewer vectors than ``count`` each begins a cluster, and
    an empty table has none.  Inertias are exact sums; one beyond 64 bits is an error.  Other
    columns are ignored.
    """
    rows = landed(whole(vectors))
    first = first_centroids(rows, count)
    if not len(first):
        return rows.selectExpr(
            "vec_id", "0 as cluster", "0L as distance", "0L as cluster_inertia", "0L as inertia", "'' as centroid_sha256"
        )
    history, state = [first], rows
    for _ in range(rounds):
        state = step(state, history)
        history.append(means(state, history[-1]))
    found = _distances(step(state, history), history[-1])
    total = F.sum(F.col("distance").cast("decimal(38,0)"))
    inertia = found.groupBy("cluster").agg(total.alias("sum")).collect()
    whole_sum = int(sum(r["sum"] for r in inertia))
    known = [(r["cluster"], int(r["sum"]), whole_sum, name_of(history[-1][r["cluster"]])) for r in inertia]
    told = rows.sparkSession.createDataFrame(known, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # One row for each centroid.
    joined = found.join(F.broadcast(told), "cluster")
    return joined.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _assigned(name: str, centroids: str) -> str:
    return f"""
{name} as (
  select r, x, arg_min(c, (d, c)) as c, min(d) as d from (
    select r, x, c, list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as d
    from kept, {centroids}) group by r, x),"""


def _moved(name: str, assigned: str, before: str) -> str:
    return f"""
{name}_sums as (
  select c, place, sum(v) as s, count(*) as n from (
    select c, unnest(x) as v, unnest(range(1, {DIMENSIONS + 1})) as place from {assigned}) group by c, place),
{name} as (
  select b.c, coalesce(m.y, b.y) as y from {before} b left join (
    select c, list(cast((s - (((s % n) + n) % n)) // n as bigint) order by place) as y from {name}_sums group by c) m using (c)),"""


def sql(count: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    out = f"""
with kept as (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda v: cast(floor({SCALE} * cast(v as double)) as bigint)) as x
  from embeddings
  where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda v: v is null or not isfinite(v))) = 0),
c0 as (
  select row_number() over (order by h, x) - 1 as c, x as y from (
    select sha256('{SEED}' || coalesce(cast(vec_id as varchar), '')) as h, x from kept order by h, x limit {count})),"""
    for i in range(rounds):
        out += _assigned(f"a{i}", f"c{i}") + _moved(f"c{i + 1}", f"a{i}", f"c{i}")
    out += _assigned("last", f"c{rounds}")
    return out.rstrip(",") + f"""
select kept.vec_id, cast(c as integer) as cluster, cast(d as bigint) as distance,
  cast(sum(d) over (partition by c) as bigint) as cluster_inertia, cast(sum(d) over () as bigint) as inertia,
  sha256(array_to_string(y, ',')) as centroid_sha256
from last join kept using (r) join c{rounds} using (c)
"""


CLUSTER_SQL = sql()
