"""Quality gate: counts, reasons, checks and the decision to publish."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gradeflow.contract import CONTRACTS, DIMENSIONS, MASTERS, REASONS, RULES
from gradeflow.functions.rules import IS_VALID
from gradeflow.sources.workspace import literal_frame

# Wording of the checks and of the decision.
TABLE_CHECK = "Rechazo en %s"
TABLE_DETAIL = "%d de %d filas rechazadas (%.2f %%); máximo %.2f %%"
MASTER_CHECK = "Tabla maestra %s con datos válidos"
MASTER_DETAIL = "%d filas válidas"
CONSERVATION_CHECK = "Conservación de filas"
CONSERVATION_DETAIL = "recibidas = aceptadas + rechazadas (%d = %d + %d)"
PUBLISHED = "Publicado: las filas válidas pasan a Gold y las observadas quedan en cuarentena"
BLOCKED = "Bloqueado: Gold no se publica porque el lote no cumple los controles de calidad"

TABLE_ORDER = {name: place for place, name in enumerate(CONTRACTS)}
RATIO_DIGITS = 6


NUMBERS = ("recibidas", "aceptadas", "rechazadas")


def check_tolerance(tolerance: float) -> float:
    """A tolerance is a finite number from 0 to 1."""
    if not 0.0 <= tolerance <= 1.0:
        raise ValueError(f"tolerance must be between 0 and 1, not {tolerance}")
    return tolerance


def table_counts(checked: dict[str, DataFrame]) -> DataFrame:
    """Rows received, accepted and rejected per table; empty tables included."""
    parts = [
        df.agg(
            F.count(F.lit(1)).alias("recibidas"),
            F.expr(f"count_if({IS_VALID})").alias("aceptadas"),
            F.expr(f"count_if(not {IS_VALID})").alias("rechazadas"),
        ).select(F.lit(name).alias("tabla"), "recibidas", "aceptadas", "rechazadas")
        for name, df in checked.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def reason_counts(checked: dict[str, DataFrame]) -> DataFrame:
    """Rows per table and reason; a row counts once for each reason it has."""
    parts = [
        df.filter(f"not {IS_VALID}").select(F.lit(name).alias("tabla"), REASONS)
        for name, df in checked.items()
    ]
    return count_reasons(reduce(DataFrame.unionByName, parts))


def count_reasons(rejected: DataFrame) -> DataFrame:
    """The same from a quarantine table."""
    reason = F.explode(F.split(REASONS, r"\|")).alias("motivo")
    exploded = rejected.select("tabla", reason)
    return exploded.groupBy("tabla", "motivo").agg(F.count(F.lit(1)).alias("filas"))


def reason_order() -> list[Column]:
    """Tables in batch order, then the most frequent reason first."""
    place = F.create_map(*[F.lit(x) for pair in TABLE_ORDER.items() for x in pair])
    return [place[F.col("tabla")], F.col("filas").desc(), F.col("motivo")]


def rule_catalogue(spark: SparkSession) -> DataFrame:
    rows = [(code, dimension, text) for code, (dimension, text) in RULES.items()]
    return literal_frame(spark, ["motivo", "dimension", "descripcion"], rows)


def reason_quality(reasons: DataFrame) -> DataFrame:
    """Reason counts with dimension and description; an unknown code is an error."""
    catalogue = F.broadcast(rule_catalogue(reasons.sparkSession))
    unknown = F.raise_error(F.concat(F.lit("reason not in the catalogue: "), F.col("motivo")))
    return reasons.join(catalogue, "motivo", "left").select(
        "tabla",
        "motivo",
        F.when(F.col("dimension").isNull(), unknown).otherwise(F.col("dimension")).alias("dimension"),
        "descripcion",
        "filas",
    )


def dimension_totals(reasons: DataFrame) -> DataFrame:
    """Reasons per quality dimension; every dimension is present."""
    spark = reasons.sparkSession
    places = [(name, place) for place, name in enumerate(DIMENSIONS, start=1)]
    every = literal_frame(spark, ["dimension", "orden"], places)
    totals = reason_quality(reasons).groupBy("dimension").agg(F.sum("filas").alias("filas"))
    return every.join(totals, "dimension", "left").select(
        "dimension", "orden", F.coalesce("filas", F.lit(0)).alias("filas")
    )


def _share(rejected: Column, received: Column) -> Column:
    """Share of rejected rows; a table without rows counts as fully rejected."""
    return F.when(received == 0, F.lit(1.0)).otherwise(rejected / received)


def table_quality(counts: DataFrame, tolerance: float) -> DataFrame:
    """Counts with the rejected share and whether it is within the tolerance."""
    share = _share(F.col("rechazadas"), F.col("recibidas"))
    return counts.select(
        "tabla",
        "recibidas",
        "aceptadas",
        "rechazadas",
        F.round(share, RATIO_DIGITS).alias("tasa_rechazo"),
        (share <= check_tolerance(tolerance)).alias("dentro_tolerancia"),
    )


def gate_checks(
    counts: DataFrame, tolerance: float, extra: list[DataFrame] | None = None
) -> DataFrame:
    """All checks of the gate: name, whether passed, detail.

    ``counts`` has one row per table; the rows are folded into one list, so that
    they are computed once.  ``extra`` adds checks of the same three columns.
    """
    checks = _folded(counts).select(F.inline(_own_checks(check_tolerance(tolerance))))
    return reduce(DataFrame.unionByName, extra or [], checks)


def _folded(counts: DataFrame) -> DataFrame:
    """One row: the counts of all tables as a list, and their totals."""
    return counts.agg(
        F.collect_list(F.struct("tabla", *NUMBERS)).alias("tablas"),
        F.struct(*[F.sum(c).alias(c) for c in NUMBERS]).alias("total"),
    )


def _own_checks(tolerance: float) -> Column:
    """The gate's checks as a list, from the folded counts."""

    def check(name: Column, passed: Column, detail: Column) -> Column:
        return F.struct(name.alias("control"), passed.alias("aprobado"), detail.alias("detalle"))

    def within_tolerance(t: Column) -> Column:
        share = _share(t["rechazadas"], t["recibidas"])
        limit = F.lit(float(tolerance))
        figures = (t["rechazadas"], t["recibidas"], share * 100, limit * 100)
        return check(
            F.format_string(TABLE_CHECK, t["tabla"]),
            share <= limit,
            F.format_string(TABLE_DETAIL, *figures),
        )

    def has_rows(t: Column) -> Column:
        return check(
            F.format_string(MASTER_CHECK, t["tabla"]),
            t["aceptadas"] > 0,
            F.format_string(MASTER_DETAIL, t["aceptadas"]),
        )

    received, accepted, rejected = (F.col(f"total.{c}") for c in NUMBERS)
    conserved = check(
        F.lit(CONSERVATION_CHECK),
        received == accepted + rejected,
        F.format_string(CONSERVATION_DETAIL, received, accepted, rejected),
    )
    masters = F.filter("tablas", lambda t: t["tabla"].isin(*MASTERS))
    return F.concat(
        F.transform("tablas", within_tolerance),
        F.transform(masters, has_rows),
        F.array(conserved),
    )


def gate_decision(
    counts: DataFrame, tolerance: float, extra: list[DataFrame] | None = None
) -> DataFrame:
    """One row: totals, rejected share, tolerance, and whether Gold is published.

    The counts are evaluated once: totals and checks come from the same folded row.
    """
    passed = F.forall(_own_checks(check_tolerance(tolerance)), lambda c: c["aprobado"])
    own = _folded(counts).select("total.*", passed.alias("aprobado"))
    rows = [own, *[checks.select("aprobado") for checks in extra or []]]
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)
    totals = merged.agg(*[F.sum(c).alias(c) for c in NUMBERS], F.min("aprobado").alias("publicado"))
    share = _share(F.col("rechazadas"), F.col("recibidas"))
    return totals.select(
        "recibidas",
        "aceptadas",
        "rechazadas",
        F.round(share, RATIO_DIGITS).alias("tasa_rechazo"),
        F.lit(float(tolerance)).alias("tolerancia"),
        "publicado",
        F.when(F.col("publicado"), PUBLISHED).otherwise(BLOCKED).alias("decision"),
    )


def stage_rows(counts: DataFrame) -> DataFrame:
    """Rows per stage and table up to Silver."""
    per_table = F.explode(
        F.array(
            F.struct(F.lit("BRONZE").alias("etapa"), F.col("recibidas").alias("filas")),
            F.struct(F.lit("QUARANTINE").alias("etapa"), F.col("rechazadas").alias("filas")),
            F.struct(F.lit("SILVER").alias("etapa"), F.col("aceptadas").alias("filas")),
        )
    ).alias("_stage")
    return counts.select("tabla", per_table).select("_stage.etapa", "tabla", "_stage.filas")


def batch_result(decision: DataFrame, primary: DataFrame) -> DataFrame:
    """One row: the decision in numbers and the rows of the primary Gold table.

    Unlike the gate, the result gives an empty batch a rejected share of zero, and
    Gold has no rows when it is not published.
    """
    share = F.when(F.col("recibidas") == 0, F.lit(0.0)).otherwise(
        F.col("rechazadas") / F.col("recibidas")
    )
    columns = ["publicado", "recibidas", "aceptadas", "rechazadas", "tolerancia"]
    head = decision.select(*columns, F.round(share, RATIO_DIGITS).alias("tasa_rechazo"))
    rows = primary.agg(F.count(F.lit(1)).alias("filas"))
    # One row each, stacked and folded.
    stacked = head.unionByName(rows, allowMissingColumns=True)
    folded = stacked.agg(*[F.max(c).alias(c) for c in stacked.columns])
    gold = F.when(F.col("publicado"), F.col("filas")).otherwise(F.lit(0).cast("long"))
    return folded.select(*head.columns, gold.alias("filas_gold"))
