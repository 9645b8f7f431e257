"""Vectors in blocks: bounded matrices that Spark deals out, one task to a pair of blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows of one block of candidates and of one block of queries.
BLOCK, QUERY_BLOCK = 2048, 1024


def usable(vectors: DataFrame, id_column: str, vector_column: str, zero: bool = True) -> DataFrame:
    """vec_id, vec (doubles): rows with an id and a vector of finite components.

    ``zero=False`` also leaves out vectors without a component other than zero.
    """
    vec = F.col(vector_column).cast("array<double>")
    infinite = float("inf")
    finite = F.forall(
        "vec", lambda x: x.isNotNull() & ~F.isnan(x) & (x < F.lit(infinite)) & (x > F.lit(-infinite))
    )
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), vec.alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull()).filter(finite)
    return rows if zero else rows.filter(F.exists("vec", lambda x: x != 0))


def queries_of(vectors: DataFrame, modulus: int) -> DataFrame:
    """One row per id divisible by ``modulus``; of several vectors the least is taken."""
    chosen = vectors.filter(F.col("vec_id") % modulus == 0)
    return chosen.groupBy("vec_id").agg(F.min("vec").alias("vec"))


def blocks(rows: DataFrame, name: str, count: int, fields: list[str], *by: str) -> DataFrame:
    """Rows dealt into ``count`` blocks: the block's number and ``rows``, an array of structs.

    Rows are dealt by position, not by key, so that no key can fill a block.
    """
    dealt = rows.withColumn(name, F.pmod(F.monotonically_increasing_id(), F.lit(count)).cast("int"))
    return dealt.groupBy(*by, name).agg(F.collect_list(F.struct(*fields)).alias("rows"))


def matrix(structs: pa.StructArray, field: str, wide: int | None = None) -> np.ndarray:
    """A field of vectors as rows of a matrix; shorter vectors end in zeros."""
    lists = structs.field(field)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    lengths = np.diff(lists.offsets.to_numpy())
    width = int(lengths.max(initial=0)) if wide is None else wide
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    ends = np.cumsum(lengths)
    for i, (n, end) in enumerate(zip(lengths, ends)):
        out[i, :n] = flat[end - n : end]
    return out


def same_width(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    width = max(a.shape[1], b.shape[1])
    return tuple(np.pad(x, ((0, 0), (0, width - x.shape[1]))) if x.shape[1] < width else x for x in (a, b))


def numbers(structs: pa.StructArray, field: str) -> np.ndarray:
    return structs.field(field).to_numpy(zero_copy_only=False)


def structs_of(batch: pa.RecordBatch, column: str, row: int) -> pa.StructArray:
    """The structs of one cell that holds an array of structs, without an offset."""
    cell = batch.column(column)[row].values
    return pa.concat_arrays([cell])
