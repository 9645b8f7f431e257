"""Merit order and top third per group, for groups of any size.

A ranking window sends a whole group to one task.  The ranked value is an average
rounded to hundredths on a 0 to 20 scale, so a group has at most 2001 different
values and null: counting the rows per value first makes the window run over that
short list only, and rows find their rank by their value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gradeflow.operators.lookup import DEFAULT_LIMITS, Limits, Size, attach, hot_threshold, shuffle_partitions

DISTINCT_AVERAGES = 2002
RANK_ROW_BYTES = 256


def _top_third(rank: Column, total: Column) -> Column:
    return rank <= F.ceil(total / 3)


def add_merit(
    totals: DataFrame,
    group: list[str],
    value: str,
    row_id: str,
    rows: int | None,
    groups: Size | None,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Add ``orden_merito`` (ties share a rank, nulls last) and ``tercio_superior``.

    ``rows`` bounds the rows of ``totals``, if known; ``groups`` the number and width
    of its groups.
    """
    columns = totals.columns
    best_first = F.col(value).desc_nulls_last()
    # A grouping key must be findable again, so the missing average gets a mark.
    marked = totals.withColumn("_value", F.coalesce(F.col(value), F.lit(-1.0)).cast("string"))
    counted = marked.groupBy(*group, "_value").agg(
        F.first(value).alias(value), F.count(F.lit(1)).alias("_rows")
    )
    ahead = W.partitionBy(*group).orderBy(best_first).rowsBetween(W.unboundedPreceding, -1)
    ranks = counted.select(
        *group,
        "_value",
        "_rows",
        (F.coalesce(F.sum("_rows").over(ahead), F.lit(0)) + 1).cast("int").alias("rank"),
        F.sum("_rows").over(W.partitionBy(*group)).alias("total"),
    )
    bound = None
    if groups is not None and groups.bytes is not None:
        list_rows = groups.rows * DISTINCT_AVERAGES
        bound = Size(list_rows, list_rows * (groups.widest + RANK_ROW_BYTES))
    key = [*group, "_value"]
    hot = None
    if rows is not None:
        threshold = hot_threshold(rows, shuffle_partitions(totals.sparkSession))
        hot = ranks.filter(F.col("_rows") > threshold).select(*key)
    reference = ranks.select(*key, "rank", "total")
    placed = attach(marked, reference, key, "_merit", size=bound, hot=hot, spread=row_id, limits=limits)
    rank, total = F.col("_merit.rank"), F.col("_merit.total")
    return placed.select(
        *columns, rank.alias("orden_merito"), _top_third(rank, total).alias("tercio_superior")
    )
