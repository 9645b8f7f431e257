"""Mix sources to target weights with hash-threshold histograms.

Every document gets a fixed hash of its id.  What a source contributes beyond whole
repeats is the set of its documents with a hash up to a cut.  The cut is located by
summing words per (source, hash bucket), finding the bucket in which the budget ends,
and splitting only that bucket again, until it holds one hash.  Nothing is sorted, and
the same hash order serves every budget, so that a larger budget keeps what a smaller
one took.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gradeflow.llm.common import WORD, landed

#: Bits of a document's hash, and bits that one refinement resolves.
HASH_BITS, STEP_BITS = 60, 12


def hash_of(doc_id: Column) -> Column:
    digest = F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, source, size in words, and the fixed hash of the id."""
    return docs.select(
        "doc_id",
        "source",
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        hash_of(F.col("doc_id")).alias("hash"),
    )


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """source, source_size, target: ``share`` of all words by weight, capped.

    Sources in code point order, null last, get the weights in turn.  Sharing what
    exceeds a cap again and again by weight ends where each source has
    min(cap, weight * level) for one level.  With the sources in order of cap / weight,
    the level is the largest of (budget - caps before) / (weights from here on).
    One row per source takes part.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(in_order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    capped = totals.select("*", weight.alias("weight"), (F.col("source_size") * most).alias("cap"))
    by_ratio = Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before, onwards = (
        by_ratio.rowsBetween(Window.unboundedPreceding, -1),
        by_ratio.rowsBetween(0, Window.unboundedFollowing),
    )
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = capped.select(
        "*",
        (
            (F.sum("source_size").over(everything) * share - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            / F.sum("weight").over(onwards)
        ).alias("level"),
    )
    return levels.select(
        "source",
        "source_size",
        F.least("cap", F.max("level").over(everything) * F.col("weight")).alias("target"),
    )


def hash_cuts(sizes: DataFrame, budgets: DataFrame) -> DataFrame:
    """source, cut: documents with a hash up to the cut come nearest to the budget.

    ``budgets`` has source and budget, up to the words of the source.
    """
    open_ = landed(
        budgets.select("source", "budget", F.lit(0).cast("long").alias("low"), F.lit(0).cast("long").alias("before"))
    )
    shift = HASH_BITS
    while True:
        width, shift = shift, max(0, shift - STEP_BITS)
        inside = sizes.alias("d").join(
            open_.alias("o"),
            F.col("d.source").eqNullSafe(F.col("o.source"))
            & (F.shiftright("d.hash", width) == F.shiftright("o.low", width)),
        )
        buckets = inside.groupBy(
            F.col("o.source").alias("source"),
            "budget",
            "before",
            F.shiftright("hash", shift).alias("bucket"),
        ).agg(F.sum("size").alias("words"), F.min("hash").alias("low"), F.max("hash").alias("high"))
        upto = Window.partitionBy("source").orderBy("bucket")
        running = buckets.withColumn("upto", F.col("before") + F.sum("words").over(upto))
        open_ = landed(
            running.filter(
                (F.col("upto") >= F.col("budget")) & (F.col("upto") - F.col("words") < F.col("budget"))
            ).select("source", "budget", "low", "high", "words", (F.col("upto") - F.col("words")).alias("before"))
        )
        if shift == 0 or open_.filter("low < high").isEmpty():
            break
    over = F.col("before") + F.col("words") - F.col("budget")
    nearer = over <= F.col("budget") - F.col("before")
    return open_.select("source", F.when(nearer, F.col("low")).otherwise(F.col("low") - 1).alias("cut"))


def planned(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """source, source_size, target, whole, cut: whole repeats of all, one more up to the cut."""
    targets = source_targets(sizes, weights, share, most)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = landed(targets.select("*", whole.cast("long").alias("whole")))
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    cuts = hash_cuts(sizes, plan.select("source", budget.alias("budget")).filter("budget > 0"))
    joined = plan.alias("p").join(cuts.alias("c"), F.col("p.source").eqNullSafe(F.col("c.source")), "left")
    return landed(joined.select("p.*", F.coalesce("cut", F.lit(-1)).alias("cut")))


def mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """doc_id, size, source_size, target, taken, repeats of every row of ``docs``.

    A document is taken whole, ``repeats`` times.  Rows with one id share its hash, so
    they are taken alike; a null id counts as empty text, a null text as no words, a
    null source as a source of its own.  The taken words of a source differ from its
    target by at most half the words that share the hash at the cut.  An empty table
    gives no rows.  Other columns are ignored.
    """
    sizes = landed(sized(docs))
    plan = planned(sizes, weights, share, most)
    joined = sizes.alias("d").join(plan.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")))
    repeats = F.col("whole") + (F.col("hash") <= F.col("cut")).cast("long")
    return joined.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * repeats).alias("taken"), repeats.alias("repeats")
    )


def apply_mix(
    docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """The rows of ``docs``, each as often as ``mix`` takes it."""
    plan = planned(landed(sized(docs)), weights, share, most)
    plan = plan.select(F.col("source").alias("_source"), F.col("whole").alias("_whole"), F.col("cut").alias("_cut"))
    joined = docs.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    repeats = F.col("_whole") + (hash_of(F.col("doc_id")) <= F.col("_cut")).cast("long")
    # Sources in which no document has a word have a target of 0 and no cut.
    taken = joined.withColumn("_repeats", repeats.cast("int")).filter("_repeats > 0")
    return taken.withColumn("_turn", F.explode(F.sequence(F.lit(1), "_repeats"))).select(docs.columns)


MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
  FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM t),
l AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
      - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST
                                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST
                        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
s AS (
  SELECT source, source_size, least(cap, max(level) OVER () * weight) AS target FROM l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM s),
h AS (SELECT source, hash, sum(size)::BIGINT AS words FROM d GROUP BY source, hash),
r AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY hash) AS upto FROM h),
c AS (
  SELECT p.source, min(r.hash) AS low, arg_min(r.upto, r.hash) AS upto, arg_min(r.words, r.hash) AS words,
         any_value(target - whole * source_size) AS budget
  FROM p JOIN r ON p.source IS NOT DISTINCT FROM r.source
  WHERE target - whole * source_size > 0 AND r.upto >= target - whole * source_size
  GROUP BY p.source),
k AS (SELECT source, CASE WHEN upto - budget <= budget - (upto - words) THEN low ELSE low - 1 END AS cut FROM c)
SELECT d.doc_id, d.size, p.source_size, p.target,
       (d.size * (p.whole + CASE WHEN d.hash <= coalesce(k.cut, -1) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN k ON k.source IS NOT DISTINCT FROM p.source
"""
