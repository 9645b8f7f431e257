"""The gate: counts, shares, checks, decision."""

from __future__ import annotations

import pytest
from batches import frames, worked_example

from gradeflow import validate
from gradeflow.plans import quality

COUNTS = "tabla string, recibidas long, aceptadas long, rechazadas long"


def counts(spark, **changes):
    rows = {t: (100, 100, 0) for t in ("semestres", "cursos", "estudiantes", "notas", "asistencia")}
    rows.update(changes)
    return spark.createDataFrame([(t, *r) for t, r in rows.items()], COUNTS)


def decide(spark, tolerance, **changes):
    table = counts(spark, **changes)
    checks = quality.gate_checks(table, tolerance)
    row = quality.gate_decision(table, tolerance).first()
    return row, {r["control"]: r for r in checks.collect()}


def test_within_tolerance(spark):
    row, checks = decide(spark, 0.05, notas=(100, 95, 5))
    assert row["publicado"] and row["decision"].startswith("Publicado")
    assert row["tasa_rechazo"] == 0.01 and row["tolerancia"] == 0.05
    assert checks["Rechazo en notas"]["detalle"] == "5 de 100 filas rechazadas (5.00 %); máximo 5.00 %"
    assert checks["Tabla maestra cursos con datos válidos"]["detalle"] == "100 filas válidas"
    assert (
        checks["Conservación de filas"]["detalle"]
        == "recibidas = aceptadas + rechazadas (500 = 495 + 5)"
    )


def test_one_table_over_tolerance_blocks(spark):
    row, checks = decide(spark, 0.05, notas=(100, 94, 6))
    assert not row["publicado"] and row["decision"].startswith("Bloqueado")
    assert not checks["Rechazo en notas"]["aprobado"] and checks["Rechazo en cursos"]["aprobado"]


def test_empty_table_is_fully_rejected(spark):
    row, checks = decide(spark, 0.5, asistencia=(0, 0, 0))
    assert not row["publicado"] and not checks["Rechazo en asistencia"]["aprobado"]
    assert decide(spark, 1.0, asistencia=(0, 0, 0))[0]["publicado"]
    row, checks = decide(spark, 1.0, cursos=(0, 0, 0))
    assert not checks["Tabla maestra cursos con datos válidos"]["aprobado"]


def test_lost_rows_are_noticed(spark):
    row, checks = decide(spark, 1.0, notas=(100, 90, 5))
    assert not row["publicado"] and not checks["Conservación de filas"]["aprobado"]


def test_counts_of_a_batch_with_an_empty_table(spark):
    batch = worked_example()
    batch["asistencia"] = []
    result = validate(frames(spark, batch))
    rows = {r["tabla"]: tuple(r)[1:] for r in quality.table_counts(result.checked).collect()}
    assert rows["asistencia"] == (0, 0, 0) and rows["notas"] == (6, 6, 0)
    totals = quality.dimension_totals(quality.reason_counts(result.checked)).collect()
    assert len(totals) == 5 and all(r["filas"] == 0 for r in totals)


def test_unknown_reason_is_an_error(spark):
    reasons = spark.createDataFrame([("notas", "OTRO", 1)], "tabla string, motivo string, filas long")
    with pytest.raises(Exception, match="OTRO"):
        quality.reason_quality(reasons).collect()


def test_dimensions_can_exceed_rejected_rows(spark):
    batch = worked_example()
    batch["notas"][0][4:6] = ["9", "99"]
    checked = validate(frames(spark, batch)).checked
    assert quality.table_counts(checked).filter("tabla = 'notas'").first()["rechazadas"] == 1
    totals = quality.dimension_totals(quality.reason_counts(checked))
    assert totals.filter("dimension = 'VALIDEZ'").first()["filas"] == 2
