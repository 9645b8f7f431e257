"""Left lookups of a unique reference, safe for hot keys and large references.

Three things can go wrong with ``facts.join(reference, key, "left")`` on a large
cluster: the reference is broadcast although it has outgrown the executors, one
key holds a third of the facts and lands in a single task, or all rows without a
key meet in one task.  ``attach`` covers the three:

* the reference is broadcast only when its measured size is within the limit;
* otherwise the facts are shuffled, and keys known to be hot (more rows than a
  shuffle partition holds on average, so at most as many as there are partitions)
  are answered from a broadcast of just their reference rows;
* rows already answered that way, and rows whose key is incomplete, get a private
  key so that the shuffle deals them out evenly.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.contract import ROW
from gradeflow.functions.rules import all_present

# A key is hot when it holds more than one in HOT_KEYS of the rows, or more than
# the mean shuffle partition if there are more partitions than that.
HOT_KEYS = 1000
# Reference row in memory besides its cells.
ROW_BYTES = 256
BROADCAST_BYTES = 64 * 1024 * 1024


@dataclass(frozen=True)
class Size:
    """Measured rows of a table, its bytes in memory (None: unknown), its widest row's."""

    rows: int
    bytes: int | None
    widest: int = 0


@dataclass(frozen=True)
class Limits:
    """What may be sent whole to every executor."""

    broadcast_bytes: int = BROADCAST_BYTES

    def broadcasts(self, size: Size | None) -> bool:
        return size is not None and size.bytes is not None and size.bytes <= self.broadcast_bytes


DEFAULT_LIMITS = Limits()


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hot_threshold(rows: int, partitions: int = HOT_KEYS) -> int:
    """Rows above which one key of a table of ``rows`` rows is hot."""
    return max(rows // max(HOT_KEYS, partitions), 1)


def hot_keys(facts: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """Keys of more rows than the threshold; counted map-side first."""
    counted = facts.filter(all_present(key)).groupBy(*key).count()
    threshold = hot_threshold(rows, shuffle_partitions(facts.sparkSession))
    return counted.filter(F.col("count") > threshold).select(*key)


def attach(
    facts: DataFrame,
    reference: DataFrame,
    key: Sequence[str],
    name: str,
    *,
    size: Size | None,
    hot: DataFrame | None = None,
    answers: DataFrame | None = None,
    spread: str = ROW,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Left join that adds the reference row as the nullable struct ``name``.

    ``reference`` has the columns of ``key`` plus the ones to bring, one row per
    key.  ``size`` is its measured size (an upper bound is enough); ``hot`` the
    keys to treat as hot when it is too large to broadcast, or ``answers`` their rows of
    the reference where these are known without a join; ``spread`` a column of
    the facts that differs from row to row, by which settled rows are dealt out.
    """
    key = list(key)
    packed = reference.select(*key, F.struct(*reference.columns).alias(name))
    if limits.broadcasts(size):
        return facts.join(F.broadcast(packed), key, "left").select(*facts.columns, name)

    columns = facts.columns
    if answers is not None or hot is not None:
        # No more hot keys than partitions: their rows are broadcast if that many fit.
        most = max(HOT_KEYS, shuffle_partitions(facts.sparkSession))
        fit = size is not None and most * (size.widest + ROW_BYTES) <= BROADCAST_BYTES
        if answers is not None:
            answers = answers.select(*key, F.struct(*reference.columns).alias("_hot"))
        else:
            answers = packed.join(hot, key, "left_semi").withColumnRenamed(name, "_hot")
        facts = facts.join(F.broadcast(answers) if fit else answers, key, "left")
    else:
        facts = facts.withColumn("_hot", F.lit(None).cast(packed.schema[name].dataType))
    # NUL never starts a trimmed cell; were it to, `_hot` still wins below.
    settled = f"_hot is not null or not {all_present(key)}"
    first = F.expr(f"if({settled}, concat(char(0), cast({spread} as string)), {key[0]})")
    shuffle_key = ["_first", *key[1:]]
    left = facts.withColumn("_first", first)
    right = packed.select(F.col(key[0]).alias("_first"), *key[1:], F.col(name).alias("_found"))
    joined = left.join(right, shuffle_key, "left")
    return joined.select(*columns, F.coalesce("_hot", "_found").alias(name))
