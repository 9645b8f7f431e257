"""Aggregates and ratios shared by the Gold tables.

Sums of doubles depend on the order in which partitions are merged, which can
flip a value that sits on a rounding tie.  Means of already rounded columns are
therefore taken over whole numbers (hundredths, ten-thousandths) and sums of raw
grades and weights over decimals: the result is the same for every partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Grades are at most 20 and weights at most 1.  Ten decimals keep what a grade sheet
# holds; sixteen keep every weight that a double can add to 1.  The sum of their
# products still has 12 digits before the point.
GRADE = "decimal(12,10)"
WEIGHT = "decimal(17,16)"


def tally(condition: Column) -> Column:
    """Rows for which the condition holds; null over no rows at all."""
    return F.sum(F.coalesce(condition, F.lit(False)).cast("int"))


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """part / whole rounded half up; null when the whole is zero or null."""
    return F.round(F.try_divide(part, whole), digits)


def rounded_mean(column: str, digits: int) -> Column:
    """Mean of a column that holds values rounded to ``digits``, itself rounded so."""
    unit = 10**digits
    steps = F.sum(F.round(F.col(column) * unit).cast("long"))
    return F.round(F.try_divide(steps, F.count(column))) / unit


def weighted_mean(column: str, weight: str, digits: int) -> Column:
    """Mean weighted by an integer column, over the rows where the value is known."""
    unit = 10**digits
    known = F.when(F.col(column).isNotNull(), F.col(weight))
    steps = F.sum(F.round(F.col(column) * unit).cast("long") * F.col(weight))
    return F.round(F.try_divide(steps, F.sum(known))) / unit


def grade_mean(column: str, digits: int = 2) -> Column:
    """Mean of raw grades, order independent."""
    total = F.sum(F.col(column).cast(GRADE))
    return F.round(F.try_divide(total, F.count(column)), digits).cast("double")


def _steps(column: Column, digits: int) -> Column:
    """A rounded column in whole steps of its last digit; their sums and squares are exact."""
    return F.round(column * 10**digits).cast("decimal(10,0)")


def _scatter(n: Column, x: Column, y: Column) -> Column:
    """n * sum(xy) - sum(x) * sum(y), whole; exact up to where it is made a double."""
    whole = "decimal(38,0)"
    product, left, right = (F.sum(c).cast(whole) for c in (x * y, x, y))
    return (n.cast("decimal(19,0)") * product).cast(whole) - (left * right).cast(whole)


def exact_stddev(column: str, digits: int) -> Column:
    """Sample deviation of a column rounded to ``digits``; null below two values."""
    x, n = _steps(F.col(column), digits), F.count(column)
    pairs = n.cast("double") * (n - 1)
    return F.sqrt(F.try_divide(_scatter(n, x, x).cast("double"), pairs)) / 10**digits


def exact_corr(left: str, left_digits: int, right: str, right_digits: int) -> Column:
    """Pearson correlation of two rounded columns over the pairs where both are known.

    Null instead of a division error when one side is constant, as it is for a
    course with perfect attendance.
    """
    both = F.col(left).isNotNull() & F.col(right).isNotNull()
    x = F.when(both, _steps(F.col(left), left_digits))
    y = F.when(both, _steps(F.col(right), right_digits))
    n = F.count(x)
    spread = F.sqrt(_scatter(n, x, x).cast("double")) * F.sqrt(_scatter(n, y, y).cast("double"))
    return F.try_divide(_scatter(n, x, y).cast("double"), spread)


def pass_rate() -> Column:
    """Passed over all decided; null while nobody has passed or failed by grade."""
    decided = F.col("aprobados") + F.col("desaprobados")
    return F.when(decided > 0, ratio(F.col("aprobados"), decided + F.col("inhabilitados")))


def distinct_count(df: DataFrame, column: str) -> Column:
    """Different values of a column of ``df``, as one value to select.

    Several distinct counts in one aggregate copy every row once for each of them.  This
    reads the one column again instead, and repeats are dropped before the shuffle.
    """
    return df.select(column).distinct().agg(F.count(column)).scalar()
