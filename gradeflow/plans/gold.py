"""What Gold tables are made from and how a set of them is put together."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.operators.lookup import DEFAULT_LIMITS, Limits, Size


@dataclass(frozen=True)
class GoldInputs:
    """Silver tables, their measured sizes and, once built, the primary table.

    The sizes are upper bounds: those of the Bronze tables will do.
    """

    silver: dict[str, DataFrame]
    sizes: dict[str, Size]
    limits: Limits = DEFAULT_LIMITS
    primary: DataFrame | None = None

    def with_primary(self, primary: DataFrame) -> GoldInputs:
        return replace(self, primary=primary)

    def small(self, table: str, df: DataFrame) -> DataFrame:
        """``df``, some columns of ``table``, to be broadcast if the table is small."""
        return F.broadcast(df) if self.limits.broadcasts(self.sizes.get(table)) else df

    def course_names(self) -> DataFrame:
        names = self.silver["cursos"].select("curso_id", F.col("nombre").alias("curso"))
        return self.small("cursos", names)


@dataclass(frozen=True)
class GoldTable:
    """A Gold table: its rows, and the order in which they are published.

    The order ends in the table's key, so that it is total and a range
    partitioning can split any run of equal leading values.  Tables that are not
    ``from_primary`` need Silver only.
    """

    name: str
    build: Callable[[GoldInputs], DataFrame]
    order: Callable[[], list[Column]]
    from_primary: bool = True

    def ordered(self, df: DataFrame) -> DataFrame:
        return df.orderBy(*self.order())


@dataclass(frozen=True)
class Analytics:
    """A primary table, the tables derived from it or from Silver, and a summary.

    The primary is built once; whoever runs the set decides how it is kept.
    """

    name: str
    description: str
    primary: GoldTable
    tables: tuple[GoldTable, ...]
    summary: Callable[[GoldInputs], DataFrame]

    def __post_init__(self):
        names = [t.name for t in self.all_tables()]
        if len(set(names)) != len(names):
            raise ValueError(f"repeated table names in {self.name}: {names}")

    def all_tables(self) -> tuple[GoldTable, ...]:
        return (self.primary, *self.tables)

    def table(self, name: str) -> GoldTable:
        for table in self.all_tables():
            if table.name == name:
                return table
        raise ValueError(f"{self.name} has no table {name!r}")

    def build(self, inputs: GoldInputs, name: str) -> DataFrame:
        """One table of the set by name, in published order."""
        table = self.table(name)
        derived = table is not self.primary and table.from_primary
        if derived and inputs.primary is None:
            inputs = inputs.with_primary(self.primary.build(inputs))
        return table.ordered(table.build(inputs))


def keys(*columns: str) -> Callable[[], list[Column]]:
    """Ascending order by the given columns."""
    return lambda: [F.col(c) for c in columns]
