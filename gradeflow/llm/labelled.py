"""A bounded sample of labelled documents for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import in_share, landed, split_remainder


def sample(
    docs: DataFrame, labels: DataFrame, label: str, learnable: Column, size: int, characters: int | None = None
) -> DataFrame:
    """doc_id, text, label of about ``size`` labelled documents, written once.

    Only labels for which ``learnable`` holds are looked at.  Of several labels of one
    id the largest counts; ids and labels that are null are left out.  Equal texts are
    one example, under their smallest id and with their largest label.  If they have more
    than ``characters`` in all, only about the share of them that fits is kept, and none longer
    than that alone.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.filter("doc_id is not null and label is not null").filter(learnable)
    known = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    share = size / max(1, known.count())
    chosen = known.filter(in_share(share, "doc_id", F.lit(label))) if share < 1 else known
    # About ``size`` rows of two numbers.
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "doc_id")
    one = rows.groupBy(F.sha2("text", 256).alias("digest")).agg(
        F.min("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("label").alias("label")
    )
    found = landed(one.select("doc_id", "text", "label"))
    if characters is None:
        return found
    fitting = found.filter(F.length("text") <= characters)
    total = fitting.agg(F.sum(F.length("text"))).first()[0] or 0
    return fitting.filter(in_share(characters / total, "doc_id", F.lit("length"))) if total > characters else fitting


def held_out(modulus: int, remainder: int) -> Column:
    return split_remainder("doc_id", modulus) == remainder
