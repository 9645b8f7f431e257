"""Every student of a term with every course of that term.

The expansion is what an enrolment is defined as.  Only its inputs can be skewed:
one term may hold a third of the students.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.operators.lookup import DEFAULT_LIMITS, Limits, Size

# Students of a term that are joined with its courses together.
PART = 1 << 16


def enrol(
    students: DataFrame,
    catalogue: DataFrame,
    term: str,
    student: str,
    size: Size | None,
    limits: Limits = DEFAULT_LIMITS,
    part: int = PART,
) -> DataFrame:
    """Inner join on the term that leaves no term to a single task.

    A catalogue within the limit is broadcast and nothing is shuffled.  Beyond it the
    students of each term are counted, and a term of more than ``part`` is dealt by student
    into as many parts as that takes; its catalogue is repeated once per part, and all
    others once.  There are fewer large terms than students over ``part``.
    """
    if limits.broadcasts(size):
        return students.join(F.broadcast(catalogue), term)
    large = F.broadcast(large_terms(students, term, part))
    parts = F.coalesce("_parts", F.lit(1))
    dealt = students.join(large, term, "left").withColumn("_part", F.pmod(F.xxhash64(student), parts).cast("int"))
    every_part = F.explode(F.sequence(F.lit(0), parts - 1))
    repeated = catalogue.join(large, term, "left").withColumn("_part", every_part).drop("_parts")
    return dealt.drop("_parts").join(repeated, [term, "_part"]).drop("_part")


def large_terms(students: DataFrame, term: str, part: int) -> DataFrame:
    """Terms of more than ``part`` students, and the ``_parts`` of at most so many each."""
    counted = students.groupBy(term).agg(F.count(F.lit(1)).alias("_students"))
    large = counted.filter(F.col("_students") > part)
    return large.select(term, F.ceil(F.col("_students") / part).cast("int").alias("_parts"))
