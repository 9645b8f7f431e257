"""Bronze: the input tables as normalised, numbered text."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.contract import CONTRACTS, MASTERS, POLICY, ROW, Policy, TableContract, contract
from gradeflow.operators.lookup import DEFAULT_LIMITS, Limits, Size
from gradeflow.operators.numbering import (
    dealt_out,
    number_parquet,
    number_tagged,
    split_offsets,
    tag_splits,
)
from gradeflow.sources.workspace import Workspace, side_by_side, text_size, to_size


def cell(sql: str, column: str) -> str:
    """A cell without surrounding blanks; null when nothing is left."""
    return f"nullif(trim({sql}), '') as {column}"


def normalise(df: DataFrame, table: TableContract) -> DataFrame:
    """Contract columns as normalised cells; other columns pass unchanged."""
    extra = [c for c in df.columns if c not in table.columns]
    return df.selectExpr(*[cell(c, c) for c in table.columns], *extra)


def _existing(table: TableContract, folder: str, load):
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"table {table.name!r} is missing in {folder}") from error
        raise


def read_csv(
    spark: SparkSession,
    folder: str,
    name: str,
    workspace: Workspace,
    check_header: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Read ``<folder>/<name>.csv``, a file or a folder of files, any Hadoop URI.

    Columns bind by position; ``check_header`` makes a header that differs from
    the contract an error.  The table is written to the workspace first, see
    ``number_tagged``.
    """
    table = contract(name)
    reader = (
        spark.read.schema(table.text_schema())
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .option("escape", '"')
        .option("enforceSchema", not check_header)
    )
    raw = _existing(table, folder, lambda: reader.csv(f"{folder.rstrip('/')}/{name}.csv"))
    landed = workspace.land(f"bronze/{name}", normalise(tag_splits(raw), table))
    offsets, size = workspace.land_sized(f"offsets/{name}", split_offsets(landed))
    return number_tagged(landed, offsets, size, limits)


def read_parquet(spark: SparkSession, folder: str, name: str, limits: Limits = DEFAULT_LIMITS) -> DataFrame:
    """Read ``<folder>/<name>.parquet`` whose columns are cast to text."""
    table = contract(name)
    raw = _existing(
        table, folder, lambda: spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")
    )
    numbered = dealt_out(number_parquet(raw, limits), raw)
    cells = [cell(f"cast({c} as string)", c) for c in table.columns]
    return numbered.selectExpr(*cells, ROW)


def read_bronze(
    spark: SparkSession,
    folder: str,
    fmt: str = "csv",
    workspace: Workspace | None = None,
    check_header: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> dict[str, DataFrame]:
    """All five tables of a batch; a missing one is an error that names it."""
    if fmt == "parquet":
        return {name: read_parquet(spark, folder, name, limits) for name in CONTRACTS}
    if fmt != "csv":
        raise ValueError(f"unknown input format {fmt!r}")
    workspace = workspace or Workspace(spark)

    def reading(name: str):
        return lambda: read_csv(spark, folder, name, workspace, check_header, limits)

    return side_by_side({name: reading(name) for name in CONTRACTS})


def table_profile(name: str, df: DataFrame, sized: bool) -> DataFrame:
    """One row: table, rows, and for the sized ones bounds on their bytes in memory."""
    cells = df.select(*contract(name).columns)
    rows, *sizes = text_size(cells)
    if not sized:
        unknown = F.max(F.lit(None).cast("long"))
        sizes = [unknown.alias("bytes"), unknown.alias("mayor")]
    return cells.agg(rows, *sizes).select(F.lit(name).alias("tabla"), "filas", "bytes", "mayor")


def profile(bronze: dict[str, DataFrame]) -> dict[str, Size]:
    """Measured size of every table in one job.

    The masters are measured in bytes, since they may be broadcast; the facts are
    only counted.
    """
    parts = [table_profile(name, df, name in MASTERS) for name, df in bronze.items()]
    return {r["tabla"]: to_size(r) for r in reduce(DataFrame.unionByName, parts).collect()}


def describe(sizes: dict[str, Size]) -> str:
    return ", ".join(f"{name} {size.rows}" for name, size in sizes.items())


def limit_report(bronze: dict[str, DataFrame], policy: Policy = POLICY) -> DataFrame:
    """Upload limits per table: rows, text bytes and longest cell against the policy."""
    parts = []
    for name, df in bronze.items():
        columns = contract(name).columns
        longest = ", ".join(f"coalesce(length({c}), 0)" for c in columns)
        size = " + ".join(f"coalesce(octet_length({c}), 0)" for c in columns)
        limits = df.agg(
            F.expr("count(1) as filas"),
            F.expr(f"coalesce(sum({size}), 0) as bytes"),
            F.expr(f"coalesce(max(greatest({longest})), 0) as celda_mas_larga"),
        )
        parts.append(limits.withColumn("tabla", F.lit(name)))
    within = (
        (F.col("filas") <= policy.max_rows_per_table)
        & (F.col("bytes") <= policy.max_bytes_per_table)
        & (F.col("celda_mas_larga") <= policy.max_cell_length)
    )
    return reduce(DataFrame.unionByName, parts).select(
        "tabla", "filas", "bytes", "celda_mas_larga", within.alias("dentro_del_limite")
    )


def header_matches(spark: SparkSession, folder: str, name: str) -> bool:
    """Whether the header of a CSV table names the contract columns in order."""
    table = contract(name)
    reader = spark.read.option("header", True).option("encoding", "UTF-8")
    raw = _existing(table, folder, lambda: reader.csv(f"{folder.rstrip('/')}/{name}.csv"))
    found = [c.strip().lstrip("﻿") for c in raw.columns]
    return found == list(table.columns)
