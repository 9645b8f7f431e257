"""Entry points of the driver: the flagship query, all queries, and their SQL.

Every query derives an academic batch from whole driver tables (see
``gradeflow/sources/star_schema.py``) and runs one operator or Gold table on it.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import oracle  # noqa: E402
from gradeflow.contract import CONTRACTS, FACTS, MASTERS, POLICY, ROW  # noqa: E402
from gradeflow.functions.cells import csv_cells  # noqa: E402
from gradeflow.operators.duplicates import repeated_keys  # noqa: E402
from gradeflow.operators.numbering import number_parquet  # noqa: E402
from gradeflow.plans import performance, quality  # noqa: E402
from gradeflow.plans.alerts import ALERTS  # noqa: E402
from gradeflow.plans.gold import Analytics, GoldInputs  # noqa: E402
from gradeflow.plans.performance import PERFORMANCE  # noqa: E402
from gradeflow.plans.validation import (  # noqa: E402
    Validation,
    course_reference,
    student_reference,
    term_reference,
    to_quarantine,
    validate,
)
from gradeflow.plans.batch import MANIFEST, METRICS, current_run, read_silver, rebuild, run_batch  # noqa: E402
from gradeflow.sinks.publish import publish, write_csv  # noqa: E402
from gradeflow.sources.bronze import header_matches, limit_report, read_csv, table_profile  # noqa: E402
from gradeflow.sources.star_schema import academic_batch, derive  # noqa: E402
from gradeflow.sources.workspace import Workspace  # noqa: E402

try:
    import corpus_pipeline
    from gradeflow.llm import queries as llm
except ModuleNotFoundError as absent:
    # Only where the subpackage itself is not there; what is missing inside it is an error.
    if absent.name not in ("corpus_pipeline", "gradeflow.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]
PARENTS = {"semestres": (), "cursos": ("semestres",), "estudiantes": ("semestres",)}
ALL = (*MASTERS, *FACTS)


def _needed(*tables: str) -> tuple[str, ...]:
    """The tables with all their ancestors, in batch order."""
    wanted = set(tables)
    for table in tables:
        wanted.update(PARENTS.get(table, MASTERS))
    return tuple(t for t in CONTRACTS if t in wanted)


def _validated(spark: SparkSession, folder: str, *tables: str) -> Validation:
    needed = _needed(*tables)
    return validate(academic_batch(spark, folder, needed), tables=needed)


def _inputs(spark: SparkSession, folder: str, *tables: str) -> GoldInputs:
    result = _validated(spark, folder, *tables)
    return GoldInputs(result.silver, result.sizes)


def _bronze(name: str) -> Query:
    return lambda spark, folder: derive(spark, folder, name)


def _reasons(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        checked = _validated(spark, folder, name).checked[name]
        return checked.select(*CONTRACTS[name].key, ROW, "motivos")

    return run


def _silver(name: str) -> Query:
    return lambda spark, folder: _validated(spark, folder, name).silver[name]


def _repeated(name: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return repeated_keys(_validated(spark, folder, name).flagged[name], CONTRACTS[name])

    return run


def _bronze_counts(spark: SparkSession, folder: str) -> DataFrame:
    parts = [
        table_profile(name, df, sized=False).select("tabla", "filas")
        for name, df in academic_batch(spark, folder).items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _terms(spark: SparkSession, folder: str) -> DataFrame:
    return term_reference(_validated(spark, folder, "semestres").silver)


def _courses(spark: SparkSession, folder: str) -> DataFrame:
    return course_reference(_validated(spark, folder, "cursos").silver, terms_fit=True)


def _students(spark: SparkSession, folder: str) -> DataFrame:
    return student_reference(_validated(spark, folder, "estudiantes").silver)


def _quarantine(spark: SparkSession, folder: str) -> DataFrame:
    return _validated(spark, folder, *ALL).quarantine()


def _counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.table_counts(_validated(spark, folder, *ALL).checked)


def _reason_counts(spark: SparkSession, folder: str) -> DataFrame:
    counts = quality.reason_counts(_validated(spark, folder, *ALL).checked)
    return counts.orderBy(*quality.reason_order())


def _reason_quality(spark: SparkSession, folder: str) -> DataFrame:
    counts = quality.reason_counts(_validated(spark, folder, *ALL).checked)
    return quality.reason_quality(counts)


def _dimension_totals(spark: SparkSession, folder: str) -> DataFrame:
    counts = quality.reason_counts(_validated(spark, folder, *ALL).checked)
    return quality.dimension_totals(counts)


def _table_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.table_quality(_counts(spark, folder), POLICY.default_tolerance)


def _gate_checks(spark: SparkSession, folder: str) -> DataFrame:
    return quality.gate_checks(_counts(spark, folder), POLICY.default_tolerance)


def _gate_decision(spark: SparkSession, folder: str) -> DataFrame:
    return quality.gate_decision(_counts(spark, folder), POLICY.default_tolerance)


def _stage_rows(spark: SparkSession, folder: str) -> DataFrame:
    return quality.stage_rows(_counts(spark, folder))


def _batch_result(spark: SparkSession, folder: str) -> DataFrame:
    """The alert job's result when every reject is tolerated, so that Gold counts."""
    result = _validated(spark, folder, *ALL)
    decision = quality.gate_decision(quality.table_counts(result.checked), 1.0)
    primary = ALERTS.primary.build(GoldInputs(result.silver, result.sizes))
    return quality.batch_result(decision, primary)


def _enrolments(spark: SparkSession, folder: str) -> DataFrame:
    return performance.enrolments(_inputs(spark, folder, "cursos", "estudiantes"))


def _grades_by_enrolment(spark: SparkSession, folder: str) -> DataFrame:
    silver = _validated(spark, folder, "notas").silver
    totals = performance.grades_by_enrolment(silver["notas"])
    # Exact decimals, shown as doubles like every other published number.
    exact = ("peso_total", "peso_registrado", "puntaje")
    return totals.withColumns({c: F.col(c).cast("double") for c in exact})


def _attendance_by_enrolment(spark: SparkSession, folder: str) -> DataFrame:
    silver = _validated(spark, folder, "asistencia").silver
    return performance.attendance_by_enrolment(silver["asistencia"])


def _gold(analytics: Analytics, name: str, *tables: str) -> Query:
    return lambda spark, folder: analytics.build(_inputs(spark, folder, *tables), name)


def _summary(analytics: Analytics, *tables: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        inputs = _inputs(spark, folder, *tables)
        # Read several times, as in a run.
        primary = Workspace(spark).land(analytics.primary.name, analytics.primary.build(inputs))
        return analytics.summary(inputs.with_primary(primary))

    return run


def _csv_bronze(name: str) -> Query:
    """The table written as CSV in several files and read back, numbered over all of them."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        workspace = Workspace(spark)
        ranges = derive(spark, folder, name).repartitionByRange(ROW).sortWithinPartitions(ROW)
        write_csv(ranges.drop(ROW), f"{workspace.folder}/in/{name}")
        return read_csv(spark, f"{workspace.folder}/in", name, workspace)

    return run


def _in_order(df: DataFrame, name: str, order: list[Column], finish: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """The published Parquet table with each row's position over its files."""
    target = Workspace(df.sparkSession).folder
    publish(df, target, name, order, finish=finish)
    written = df.sparkSession.read.parquet(f"{target}/{name}.parquet")
    return number_parquet(written).withColumn("posicion", F.col(ROW) - 1).drop(ROW)


def _published(analytics: Analytics, name: str, *tables: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        table = analytics.table(name)
        inputs = _inputs(spark, folder, *tables)
        if table is not analytics.primary and table.from_primary:
            inputs = inputs.with_primary(analytics.primary.build(inputs))
        return _in_order(table.build(inputs), name, table.order())

    return run


def _published_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rejected = _validated(spark, folder, *ALL).rejected()
    order = [F.col("tabla"), F.col(ROW)]
    rows = _in_order(rejected, "rechazados", order, lambda df: to_quarantine(df).withColumnRenamed(ROW, "fila_origen"))
    return rows.select("tabla", F.col("fila_origen").alias(ROW), "motivos", "posicion")


def _published_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of all tables of a published run, as its Parquet and its CSV files hold them."""
    output = f"{Workspace(spark).folder}/out"
    result = run_batch(spark, academic_batch(spark, folder), output, ALERTS, 1.0)
    parts = [("quarantine", "rechazados"), *[("silver", t) for t in CONTRACTS]]
    parts += [("gold", t.name) for t in ALERTS.all_tables()]
    rows = []
    for stage, name in parts:
        path = f"{current_run(spark, output)}/{stage}/{name}"
        typed = spark.read.parquet(f"{path}.parquet").agg(F.count(F.lit(1)).alias("filas_parquet"))
        text = spark.read.option("header", True).option("escape", '"').csv(f"{path}.csv")
        text = text.agg(F.count(F.lit(1)).alias("filas_csv"))
        both = typed.unionByName(text, allowMissingColumns=True)
        folded = both.agg(*[F.max(c).alias(c) for c in both.columns])
        rows.append(folded.select(F.lit(stage).alias("etapa"), F.lit(name).alias("tabla"), "*"))
    assert result.folder == current_run(spark, output)
    return reduce(DataFrame.unionByName, rows)


def _gate_effect(spark: SparkSession, folder: str) -> DataFrame:
    """Tables per stage that a run at the default tolerance left, from its manifest."""
    output = f"{Workspace(spark).folder}/out"
    result = run_batch(spark, academic_batch(spark, folder), output, ALERTS)
    manifest = spark.read.json(f"{result.folder}/{MANIFEST}").filter("etapa not like '%.json'")
    table = F.regexp_extract("clave", r"^[^/]+/([^/.]+)\.", 1)
    named = manifest.select("etapa", table.alias("tabla")).filter("tabla <> 'resumen'").distinct()
    return named.groupBy("etapa").agg(F.count(F.lit(1)).alias("tablas"))


def _period(name: str, period: str) -> Query:
    """A table of one period, rebuilt from the Silver tables that a run published."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        output = f"{Workspace(spark).folder}/out"
        result = run_batch(spark, academic_batch(spark, folder), output, ALERTS, 1.0)
        return rebuild(spark, result.folder, PERFORMANCE, name, period)

    return run


def _published_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The one JSON object that a run published, read back with the summary's types."""
    output = f"{Workspace(spark).folder}/out"
    result = run_batch(spark, academic_batch(spark, folder), output, ALERTS, 1.0)
    primary = spark.read.parquet(f"{result.folder}/gold/{ALERTS.primary.name}.parquet")
    inputs = GoldInputs(read_silver(spark, result.folder), {}).with_primary(primary)
    schema = ALERTS.summary(inputs).schema
    return spark.read.schema(schema).option("multiLine", True).json(f"{result.folder}/gold/resumen.json")


def _run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """What two runs, one tolerating all rejects and one few, appended to the metrics of their output."""
    output = f"{Workspace(spark).folder}/out"
    for tolerance in (1.0, POLICY.default_tolerance):
        run_batch(spark, academic_batch(spark, folder), output, ALERTS, tolerance)
    lines = spark.read.schema("run_id string, etapa string, tabla string, filas long").json(f"{output}/{METRICS}")
    runs = F.count_distinct("run_id").alias("corridas")
    return lines.groupBy("etapa", "tabla").agg(runs, F.min("filas").alias("minimo"), F.max("filas").alias("maximo"))


def _gate_checks_added(spark: SparkSession, folder: str) -> DataFrame:
    """The gate with two checks of a caller's own, on Silver and on the quarantine."""
    result = _validated(spark, folder, *ALL)
    ungraded = result.silver["cursos"].join(result.silver["notas"], "curso_id", "left_anti")
    reasons = quality.reason_counts(result.checked)
    extra = [
        _count_check("Cursos con notas", ungraded, 0),
        _count_check("Motivos distintos", reasons.filter("filas > 0"), 20),
    ]
    return quality.gate_checks(quality.table_counts(result.checked), POLICY.default_tolerance, extra)


def _count_check(name: str, rows: DataFrame, most: int) -> DataFrame:
    n = F.count(F.lit(1))
    return rows.agg(F.lit(name).alias("control"), (n <= most).alias("aprobado"), n.cast("string").alias("detalle"))


def _csv_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Tables read with their headers checked, and whether a header with two columns swapped is told."""
    workspace = Workspace(spark)
    right, wrong = f"{workspace.folder}/right", f"{workspace.folder}/wrong"
    rows = []
    for name, table in CONTRACTS.items():
        bronze = derive(spark, folder, name).drop(ROW)
        first, second, *others = table.columns
        write_csv(bronze.select(*table.columns), f"{right}/{name}")
        write_csv(bronze.select(second, first, *others), f"{wrong}/{name}")
        told = [header_matches(spark, place, name) for place in (right, wrong)]
        read = read_csv(spark, right, name, workspace, check_header=True)
        flags = [F.lit(t).alias(c) for t, c in zip(told, ("en_orden", "cambiado"))]
        rows.append(read.agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), "filas", *flags))
    return reduce(DataFrame.unionByName, rows)


def _csv_cells(name: str) -> Query:
    return lambda spark, folder: csv_cells(spark.read.parquet(f"{folder}/{name}.parquet"))


def queries() -> dict[str, Query]:
    """One entry per operator or Gold table; each callable takes (spark, folder)."""
    out: dict[str, Query] = {}
    for name in CONTRACTS:
        out[f"bronze_{name}"] = _bronze(name)
        out[f"reasons_{name}"] = _reasons(name)
        out[f"silver_{name}"] = _silver(name)
    for name in FACTS:
        out[f"repeated_keys_{name}"] = _repeated(name)
    out["bronze_counts"] = _bronze_counts
    out["bronze_limits"] = lambda spark, folder: limit_report(academic_batch(spark, folder))
    out["reference_terms"] = _terms
    out["reference_courses"] = _courses
    out["reference_students"] = _students
    out["quarantine_rows"] = _quarantine
    out["table_counts"] = _counts
    out["reason_counts"] = _reason_counts
    out["reason_quality"] = _reason_quality
    out["dimension_totals"] = _dimension_totals
    out["table_quality"] = _table_quality
    out["gate_checks"] = _gate_checks
    out["gate_decision"] = _gate_decision
    out["stage_rows"] = _stage_rows
    out["batch_result"] = _batch_result
    out["enrolments"] = _enrolments
    out["grades_by_enrolment"] = _grades_by_enrolment
    out["attendance_by_enrolment"] = _attendance_by_enrolment
    # These two read only one of the facts.
    only = {"evaluaciones_resumen": ("notas",), "asistencia_semanal": ("asistencia",)}
    for table in PERFORMANCE.all_tables():
        out[f"gold_{table.name}"] = _gold(PERFORMANCE, table.name, *only.get(table.name, ALL))
    out["gold_resumen"] = _summary(PERFORMANCE, *ALL)
    for table in ALERTS.all_tables():
        out[table.name] = _gold(ALERTS, table.name, "asistencia")
    out["alertas_resumen"] = _summary(ALERTS, "asistencia")
    for name in FACTS:
        out[f"csv_bronze_{name}"] = _csv_bronze(name)
    out["published_rendimiento"] = _published(PERFORMANCE, "rendimiento", *ALL)
    out["published_alertas_asistencia"] = _published(ALERTS, "alertas_asistencia", "asistencia")
    out["published_alertas_por_curso"] = _published(ALERTS, "alertas_por_curso", "asistencia")
    out["published_rechazados"] = _published_quarantine
    out["published_tables"] = _published_tables
    out["gate_effect"] = _gate_effect
    out["published_resumen"] = _published_summary
    out["run_metrics"] = _run_metrics
    out["gate_checks_added"] = _gate_checks_added
    out["csv_headers"] = _csv_headers
    out["period_rendimiento"] = _period("rendimiento", "P2")
    out["csv_cells_lineitem"] = _csv_cells("lineitem")
    out["csv_cells_documents"] = _csv_cells("documents")
    if llm is not None:
        out |= llm.QUERIES
        out["pipeline"] = corpus_pipeline.run
    return out


def oracle_sql() -> dict[str, str]:
    """For each query the same result in SQL over the same tables."""
    out = oracle.statements()
    if llm is not None:
        out |= llm.SQL
        if corpus_pipeline.ORACLE_SQL is not None:
            out["pipeline"] = corpus_pipeline.ORACLE_SQL
    return out


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: the performance table of the smallest batch."""
    return queries()["gold_rendimiento"](spark, "/root/testdata/sf0.001")
