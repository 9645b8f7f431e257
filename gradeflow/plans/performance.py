"""Academic performance: one row per enrolment, and the summaries above it."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gradeflow.contract import APROBADO, DESAPROBADO, INHABILITADO, PENDIENTE, POLICY
from gradeflow.functions.metrics import (
    GRADE,
    WEIGHT,
    distinct_count,
    exact_corr,
    exact_stddev,
    grade_mean,
    pass_rate,
    ratio,
    rounded_mean,
    tally,
    weighted_mean,
)
from gradeflow.operators.enrol import enrol
from gradeflow.operators.lookup import Size
from gradeflow.operators.merit import add_merit
from gradeflow.plans.gold import Analytics, GoldInputs, GoldTable, keys

ENROLMENT = ["estudiante_id", "curso_id", "periodo"]

# Rounding offset of the final grade, tolerance of the weight total.
FINAL_GRADE_OFFSET = Decimal("0.500001")
WEIGHT_TOLERANCE = Decimal("0.000001")

# Alert phrases in reporting order, and their separator.
LOW_AVERAGE = "Promedio menor a 13"
OVER_LIMIT = "Inasistencias mayores al 30 %"
AT_RISK = "Inasistencias en riesgo"
PENDING = "Evaluaciones pendientes"
ALERT_SEPARATOR = "; "

# Grade ranges as (label, position, upper bound of the average).
GRADE_RANGES = (("00-10", 1, 11), ("11-12", 2, 13), ("13-16", 3, 17), ("17-20", 4, None))
NO_GRADES = ("Sin notas", 5)

# Risk of a student by the number of failed courses.
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "ALTO", "MEDIO", "BAJO"


def enrolments(inputs: GoldInputs) -> DataFrame:
    """Each valid student with each valid course of their term."""
    terms = inputs.silver["semestres"].select("semestre_id", "periodo")
    courses = inputs.silver["cursos"].select(
        "curso_id", F.col("nombre").alias("curso"), "semestre_id", "creditos", "docente"
    )
    catalogue = courses.join(inputs.small("semestres", terms), "semestre_id")
    students = inputs.silver["estudiantes"].select(
        "estudiante_id", "nombres", "apellidos", "seccion", "semestre_id"
    )
    size = _catalogue_size(inputs)
    return enrol(students, catalogue, "semestre_id", "estudiante_id", size, inputs.limits)


def _catalogue_size(inputs: GoldInputs) -> Size | None:
    """Bound on the courses with their terms: at most one widest term row each."""
    terms, courses = inputs.sizes.get("semestres"), inputs.sizes.get("cursos")
    if terms is None or courses is None or courses.bytes is None:
        return None
    return Size(courses.rows, courses.bytes + courses.rows * terms.widest)


def grades_by_enrolment(grades: DataFrame) -> DataFrame:
    """Scheduled and registered evaluations, weights and points per enrolment."""
    grade, weight = F.col("nota").cast(GRADE), F.col("peso").cast(WEIGHT)
    weight_if_graded = F.when(F.col("nota").isNotNull(), weight).otherwise(F.lit(0).cast(WEIGHT))
    return grades.groupBy(*ENROLMENT).agg(
        F.count(F.lit(1)).alias("evaluaciones"),
        F.count("nota").alias("evaluaciones_registradas"),
        F.sum(weight).alias("peso_total"),
        F.sum(weight_if_graded).alias("peso_registrado"),
        F.sum(grade * weight).alias("puntaje"),
    )


def attendance_by_enrolment(attendance: DataFrame) -> DataFrame:
    """Sessions and sessions per state for each enrolment."""
    state = F.col("estado")
    return attendance.groupBy(*ENROLMENT).agg(
        F.count(F.lit(1)).alias("sesiones"),
        tally(state == "P").alias("presentes"),
        tally(state == "T").alias("tardanzas"),
        tally(state == "F").alias("faltas"),
        tally(state == "J").alias("justificadas"),
    )


def _final_grade() -> Column:
    """Whole final grade, once every scheduled evaluation is in and weighs one."""
    complete = (
        (F.col("evaluaciones") > 0)
        & (F.col("evaluaciones") == F.col("evaluaciones_registradas"))
        & (F.abs(F.col("peso_total") - 1) < F.lit(WEIGHT_TOLERANCE))
    )
    return F.when(complete, F.floor(F.col("puntaje") + F.lit(FINAL_GRADE_OFFSET)).cast("int"))


def performance(inputs: GoldInputs) -> DataFrame:
    """One row per enrolment: grades, attendance, condition and alerts.

    The facts are aggregated to enrolments before they meet them, and the three
    sides are joined on the same key, so each is shuffled once.  What describes a
    course is added after the shuffle if it can be broadcast.
    """
    counts = [
        "evaluaciones",
        "evaluaciones_registradas",
        "sesiones",
        "presentes",
        "tardanzas",
        "faltas",
        "justificadas",
    ]
    rows, described = enrolments(inputs), ["curso", "docente", "creditos"]
    late = inputs.limits.broadcasts(_catalogue_size(inputs))
    joined = (
        (rows.drop(*described) if late else rows)
        .join(grades_by_enrolment(inputs.silver["notas"]), ENROLMENT, "left")
        .join(attendance_by_enrolment(inputs.silver["asistencia"]), ENROLMENT, "left")
        .fillna(0, subset=counts)
    )
    if late:
        names = inputs.silver["cursos"].select(
            "curso_id", F.col("nombre").alias("curso"), "docente", "creditos"
        )
        joined = joined.join(F.broadcast(names), "curso_id")
    sessions = F.col("sesiones")
    attended = F.col("presentes") + F.col("tardanzas")
    # The limit is tested on the exact ratio, the risk on the published one.
    over = F.try_divide("faltas", sessions) > POLICY.max_absence_ratio
    measured = joined.withColumns(
        {
            "promedio": ratio(F.col("puntaje"), F.col("peso_registrado"), 2).cast("double"),
            "nota_final": _final_grade(),
            "asistencia_pct": ratio(attended, sessions - F.col("justificadas")),
            "inasistencia_pct": ratio(F.col("faltas"), sessions),
            "evaluaciones_pendientes": F.col("evaluaciones") - F.col("evaluaciones_registradas"),
            "_over": F.coalesce(over, F.lit(False)),
        }
    )
    final, over = F.col("nota_final"), F.col("_over")
    low = F.coalesce(F.coalesce(final, F.col("promedio")) < POLICY.passing_score, F.lit(False))
    risk = F.coalesce(F.col("inasistencia_pct") >= POLICY.risk_absence_ratio, F.lit(False))
    condition = (
        F.when(over, INHABILITADO)
        .when(final.isNull(), PENDIENTE)
        .when(final >= POLICY.passing_score, APROBADO)
        .otherwise(DESAPROBADO)
    )
    alerts = F.concat_ws(
        ALERT_SEPARATOR,
        F.when(low, F.lit(LOW_AVERAGE)),
        F.when(over, F.lit(OVER_LIMIT)),
        F.when(risk & ~over, F.lit(AT_RISK)),
        F.when(F.col("evaluaciones_pendientes") > 0, F.lit(PENDING)),
    )
    return measured.select(
        "estudiante_id",
        "nombres",
        "apellidos",
        "seccion",
        "semestre_id",
        "periodo",
        "curso_id",
        "curso",
        "docente",
        "creditos",
        "evaluaciones",
        "evaluaciones_pendientes",
        "promedio",
        "nota_final",
        "sesiones",
        "presentes",
        "tardanzas",
        "faltas",
        "justificadas",
        "asistencia_pct",
        "inasistencia_pct",
        condition.alias("condicion"),
        (low | over | risk).alias("requiere_atencion"),
        alerts.alias("alertas"),
    )


def _in_condition(condition: str) -> Column:
    return tally(F.col("condicion") == condition)


def course_summary(inputs: GoldInputs) -> DataFrame:
    """Grades, conditions and attendance per course and period."""
    grouped = inputs.primary.groupBy("curso_id", "curso", "docente", "creditos", "periodo").agg(
        F.count(F.lit(1)).alias("matriculados"),
        _in_condition(APROBADO).alias("aprobados"),
        _in_condition(DESAPROBADO).alias("desaprobados"),
        _in_condition(INHABILITADO).alias("inhabilitados"),
        _in_condition(PENDIENTE).alias("pendientes"),
        rounded_mean("promedio", 2).alias("promedio"),
        # The exact element; an average has at most 2001 different values.
        F.round(F.expr("percentile_disc(0.5) within group (order by promedio)"), 2).alias("mediana"),
        F.min("promedio").alias("promedio_minimo"),
        F.max("promedio").alias("promedio_maximo"),
        F.round(exact_stddev("promedio", 2), 2).alias("desviacion"),
        rounded_mean("asistencia_pct", 4).alias("asistencia_promedio"),
        F.round(exact_corr("asistencia_pct", 4, "promedio", 2), 4).alias("correlacion_asistencia_nota"),
        tally(F.col("requiere_atencion")).alias("requieren_atencion"),
    )
    return grouped.withColumn("tasa_aprobacion", pass_rate())


def student_summary(inputs: GoldInputs) -> DataFrame:
    """Credits, weighted average, risk and merit order per student and period."""
    person = ["estudiante_id", "nombres", "apellidos", "seccion", "semestre_id", "periodo"]
    passed_credits = F.when(F.col("condicion") == APROBADO, F.col("creditos")).otherwise(0)
    totals = inputs.primary.groupBy(*person).agg(
        F.count(F.lit(1)).alias("cursos"),
        _in_condition(APROBADO).alias("aprobados"),
        _in_condition(DESAPROBADO).alias("desaprobados"),
        _in_condition(INHABILITADO).alias("inhabilitados"),
        _in_condition(PENDIENTE).alias("pendientes"),
        F.sum("creditos").alias("creditos_matriculados"),
        F.sum(passed_credits).alias("creditos_aprobados"),
        weighted_mean("promedio", "creditos", 2).alias("promedio_ponderado"),
        rounded_mean("asistencia_pct", 4).alias("asistencia_promedio"),
    )
    failed = F.col("desaprobados") + F.col("inhabilitados")
    risk = F.when(failed >= 2, HIGH_RISK).when(failed == 1, MEDIUM_RISK).otherwise(LOW_RISK)
    # A student has one term and so one period: their number bounds the totals.
    students = inputs.sizes.get("estudiantes")
    return add_merit(
        totals.withColumn("riesgo", risk),
        ["semestre_id", "periodo"],
        "promedio_ponderado",
        "estudiante_id",
        students.rows if students else None,
        inputs.sizes.get("semestres"),
        inputs.limits,
    )


def section_summary(inputs: GoldInputs) -> DataFrame:
    """Students, grades and attendance per section and course."""
    grouped = inputs.primary.groupBy("seccion", "curso_id", "curso").agg(
        F.countDistinct("estudiante_id").alias("estudiantes"),
        rounded_mean("promedio", 2).alias("promedio"),
        _in_condition(APROBADO).alias("aprobados"),
        _in_condition(DESAPROBADO).alias("desaprobados"),
        _in_condition(INHABILITADO).alias("inhabilitados"),
        rounded_mean("asistencia_pct", 4).alias("asistencia_promedio"),
    )
    return grouped.withColumn("tasa_aprobacion", pass_rate())


def assessment_summary(inputs: GoldInputs) -> DataFrame:
    """Registered, pending and passed grades per course and evaluation."""
    grouped = inputs.silver["notas"].groupBy("curso_id", "evaluacion").agg(
        F.min("peso").alias("peso"),
        F.count(F.lit(1)).alias("programadas"),
        F.count("nota").alias("registradas"),
        grade_mean("nota").alias("promedio"),
        tally(F.col("nota") >= POLICY.passing_score).alias("aprobados"),
        F.min("fecha_registro").alias("fecha"),
    )
    return grouped.join(inputs.course_names(), "curso_id").select(
        "curso_id",
        "curso",
        "evaluacion",
        "peso",
        "programadas",
        "registradas",
        (F.col("programadas") - F.col("registradas")).alias("pendientes"),
        "promedio",
        "aprobados",
        ratio(F.col("aprobados"), F.col("registradas")).alias("tasa_aprobacion"),
        "fecha",
    )


def grade_distribution(inputs: GoldInputs) -> DataFrame:
    """Enrolments per course and range of the average; empty ranges are left out."""
    average = F.col("promedio")
    label = F.when(average.isNull(), NO_GRADES[0])
    position = F.when(average.isNull(), NO_GRADES[1])
    for name, place, below in GRADE_RANGES:
        inside = average < below if below is not None else F.lit(True)
        label, position = label.when(inside, name), position.when(inside, place)
    ranged = inputs.primary.select(
        "curso_id", "curso", label.alias("rango"), position.alias("orden")
    )
    return ranged.groupBy("curso_id", "curso", "rango", "orden").agg(
        F.count(F.lit(1)).alias("estudiantes")
    )


def weekly_attendance(inputs: GoldInputs) -> DataFrame:
    """Attendance records per course and week."""
    state = F.col("estado")
    grouped = inputs.silver["asistencia"].groupBy("curso_id", "semana").agg(
        F.min("fecha").alias("fecha"),
        F.count(F.lit(1)).alias("registros"),
        tally(state.isin("P", "T")).alias("asistieron"),
        tally(state == "F").alias("faltas"),
        tally(state == "J").alias("justificadas"),
    )
    expected = F.col("registros") - F.col("justificadas")
    return grouped.join(inputs.course_names(), "curso_id").select(
        "curso_id",
        "curso",
        "semana",
        "fecha",
        "registros",
        "asistieron",
        "faltas",
        "justificadas",
        ratio(F.col("asistieron"), expected).alias("asistencia_pct"),
    )


def performance_summary(inputs: GoldInputs) -> DataFrame:
    """The whole batch in one row."""
    totals = inputs.primary.agg(
        F.count(F.lit(1)).alias("matriculas"),
        _in_condition(APROBADO).alias("aprobados"),
        _in_condition(DESAPROBADO).alias("desaprobados"),
        _in_condition(INHABILITADO).alias("inhabilitados"),
        _in_condition(PENDIENTE).alias("pendientes"),
        rounded_mean("promedio", 2).alias("promedio_general"),
        rounded_mean("asistencia_pct", 4).alias("asistencia_promedio"),
        tally(F.col("requiere_atencion")).alias("requieren_atencion"),
        F.round(exact_corr("asistencia_pct", 4, "promedio", 2), 4).alias("correlacion_asistencia_nota"),
        F.min("periodo").alias("periodo"),
    )
    return totals.select(
        distinct_count(inputs.primary, "estudiante_id").alias("estudiantes"),
        distinct_count(inputs.primary, "curso_id").alias("cursos"),
        "*",
        pass_rate().alias("tasa_aprobacion"),
        F.lit(POLICY.passing_score).alias("nota_aprobatoria"),
        F.lit(POLICY.max_absence_ratio).alias("maximo_inasistencia"),
    )


def _assessment_order() -> list[Column]:
    return [F.col("curso_id"), F.col("fecha").asc_nulls_last(), F.col("evaluacion")]


PERFORMANCE = Analytics(
    name="rendimiento",
    description="Averages, condition, attendance and merit order per enrolment",
    primary=GoldTable(
        "rendimiento",
        performance,
        keys("curso_id", "apellidos", "nombres", "estudiante_id", "periodo"),
    ),
    tables=(
        GoldTable(
            "cursos_resumen",
            course_summary,
            keys("curso_id", "periodo"),
        ),
        GoldTable(
            "estudiantes_resumen",
            student_summary,
            keys("orden_merito", "apellidos", "estudiante_id", "periodo"),
        ),
        GoldTable("secciones_resumen", section_summary, keys("seccion", "curso_id")),
        GoldTable("evaluaciones_resumen", assessment_summary, _assessment_order, False),
        GoldTable("distribucion_notas", grade_distribution, keys("curso_id", "orden")),
        GoldTable("asistencia_semanal", weekly_attendance, keys("curso_id", "semana"), False),
    ),
    summary=performance_summary,
)
