"""Gold tables on batches that probe their definitions."""

from __future__ import annotations

from batches import frames, worked_example

from gradeflow import ALERTS, PERFORMANCE, GoldInputs, validate
from gradeflow.plans.performance import grades_by_enrolment
from gradeflow.plans.gold import Analytics, GoldTable, keys

import pytest


def gold(spark, batch, analytics, table):
    result = validate(frames(spark, batch))
    inputs = GoldInputs(result.silver, result.sizes)
    if table == "resumen":
        return analytics.summary(inputs.with_primary(analytics.primary.build(inputs))).collect()
    return analytics.build(inputs, table).collect()


def attendance(batch, student, states):
    batch["asistencia"] += [
        [student, "TBD", "2026-II", str(week), "2026-09-01", state]
        for week, state in enumerate(states, start=1)
    ]


def test_a_constant_side_has_no_correlation(spark):
    batch = worked_example()
    batch["asistencia"] = []
    for student in ("E1", "E2", "E3"):
        attendance(batch, student, "PPPP")
    course = gold(spark, batch, PERFORMANCE, "cursos_resumen")[0]
    assert course["correlacion_asistencia_nota"] is None
    assert course["asistencia_promedio"] == 1.0


def test_student_without_facts_is_pending(spark):
    batch = worked_example()
    batch["estudiantes"].append(["E4", "Dora", "Paz", "d@x.test", "V", "B"])
    rows = {r["estudiante_id"]: r for r in gold(spark, batch, PERFORMANCE, "rendimiento")}
    new = rows["E4"]
    assert new["condicion"] == "PENDIENTE" and not new["requiere_atencion"]
    assert (new["evaluaciones"], new["sesiones"], new["promedio"]) == (0, 0, None)
    assert new["asistencia_pct"] is None and new["alertas"] == ""


def test_limit_is_exact_and_risk_is_published(spark):
    """3 of 10 is not over the limit; 2999 of 15000 rounds up to the risk share."""
    batch = worked_example()
    batch["asistencia"] = []
    attendance(batch, "E1", "FFF" + "P" * 7)
    attendance(batch, "E2", "F" * 1999 + "P" * 7999)
    rows = {r["estudiante_id"]: r for r in gold(spark, batch, PERFORMANCE, "rendimiento")}
    assert rows["E1"]["condicion"] == "APROBADO" and rows["E1"]["inasistencia_pct"] == 0.3
    assert rows["E2"]["inasistencia_pct"] == 0.1999
    levels = {r["estudiante_id"]: r["nivel"] for r in gold(spark, batch, ALERTS, "alertas_asistencia")}
    assert levels == {"E1": "EN_RIESGO", "E2": "NORMAL"}


def test_rounded_risk_differs_from_level(spark):
    batch = worked_example()
    batch["asistencia"] = []
    attendance(batch, "E1", "F" * 4999 + "P" * 19997)
    rows = {r["estudiante_id"]: r for r in gold(spark, batch, PERFORMANCE, "rendimiento")}
    assert rows["E1"]["inasistencia_pct"] == 0.2
    assert "riesgo" in rows["E1"]["alertas"]
    levels = {r["estudiante_id"]: r["nivel"] for r in gold(spark, batch, ALERTS, "alertas_asistencia")}
    assert levels == {"E1": "NORMAL"}


def test_final_grade_absorbs_binary_error(spark):
    """Half a point up: 12.5 becomes 13, 12.49 stays 12; weights must add up to one."""
    batch = worked_example()
    weights = ("0.1", "0.2", "0.7")
    batch["notas"] = []
    for student, grades in {"E1": ("12.5",) * 3, "E2": ("12.49",) * 3, "E3": ("15", "15", "15")}.items():
        for evaluation, weight, grade in zip("ABC", weights, grades):
            if student == "E3" and evaluation == "C":
                weight = "0.6"
            batch["notas"].append([student, "TBD", "2026-II", evaluation, weight, grade, None])
    rows = {r["estudiante_id"]: r for r in gold(spark, batch, PERFORMANCE, "rendimiento")}
    assert [rows[e]["nota_final"] for e in ("E1", "E2", "E3")] == [13, 12, None]
    assert rows["E3"]["promedio"] == 15.0


def test_means_round_half_up_exactly(spark):
    """The mean of 12.42 and 12.43 is a tie at the third digit."""
    batch = worked_example()
    batch["notas"] = [
        [student, "TBD", "2026-II", "EP", "1", grade, None]
        for student, grade in (("E1", "12.42"), ("E2", "12.43"))
    ]
    assert gold(spark, batch, PERFORMANCE, "cursos_resumen")[0]["promedio"] == 12.43
    assert gold(spark, batch, PERFORMANCE, "evaluaciones_resumen")[0]["promedio"] == 12.43


def test_small_weights_count(spark):
    shape = "estudiante_id string, curso_id string, periodo string, peso double, nota double"
    grades = spark.createDataFrame([("E", "C", "P", 4e-11, 10.0), ("E", "C", "P", 1.0, 12.5)], shape)
    row = grades_by_enrolment(grades).first()
    assert float(row["peso_total"]) == 1 + 4e-11 and float(row["puntaje"]) == 12.5 + 4e-10


def test_empty_summary_has_null_counts(spark):
    batch = worked_example()
    batch["asistencia"] = []
    row = gold(spark, batch, ALERTS, "resumen")[0]
    assert (row["matriculas"], row["estudiantes"], row["inhabilitados"]) == (0, 0, None)


def test_ranges_and_order(spark):
    batch = worked_example()
    rows = gold(spark, batch, PERFORMANCE, "distribucion_notas")
    assert [(r["rango"], r["orden"], r["estudiantes"]) for r in rows] == [
        ("00-10", 1, 1),
        ("11-12", 2, 1),
        ("17-20", 4, 1),
    ]
    weekly = gold(spark, batch, PERFORMANCE, "asistencia_semanal")
    assert [(r["semana"], r["registros"], r["asistieron"]) for r in weekly] == [
        (1, 3, 3),
        (2, 3, 2),
        (3, 3, 2),
        (4, 3, 1),
    ]
    assert weekly[3]["asistencia_pct"] == 0.5


def test_own_analytics(spark):
    """A new table is a function of the inputs; the primary must have its own name."""
    extra = GoldTable("extra", lambda inputs: inputs.primary.select("curso_id").distinct(), keys("curso_id"))
    mine = Analytics("mia", "", PERFORMANCE.primary, (extra,), PERFORMANCE.summary)
    assert [r["curso_id"] for r in gold(spark, worked_example(), mine, "extra")] == ["TBD"]
    with pytest.raises(ValueError, match="repeated"):
        Analytics("mia", "", extra, (extra,), PERFORMANCE.summary)
    with pytest.raises(ValueError, match="no table"):
        PERFORMANCE.table("extra")


def test_summaries_copy_no_row_per_distinct_count(spark):
    batch = worked_example()
    for analytics in (PERFORMANCE, ALERTS):
        result = validate(frames(spark, batch))
        inputs = GoldInputs(result.silver, result.sizes)
        summary = analytics.summary(inputs.with_primary(analytics.primary.build(inputs)))
        plan = summary._jdf.queryExecution().executedPlan().toString()
        assert "Expand" not in plan
        assert summary.first()["estudiantes"] == 3
