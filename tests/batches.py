"""Small batches written as literal rows."""

from __future__ import annotations

import csv
import os

from gradeflow.contract import CONTRACTS, ROW

TERM = ["V", "5", "Quinto semestre", "2026-II", "2026-08-17", "2026-12-18"]
COURSE = ["TBD", "Talleres de Big Data", "V", "4", "6", "Docente Uno"]
STUDENTS = [
    ["E1", "Ana", "Zavala", "ana@x.test", "V", "A"],
    ["E2", "Beto", "Mora", "beto@x.test", "V", "A"],
    ["E3", "Caro", "Luna", "caro@x.test", "V", "B"],
]
WEEKS = ["2026-08-17", "2026-08-24", "2026-08-31", "2026-09-07"]
STATES = {"E1": "PPTF", "E2": "PPPJ", "E3": "PFFP"}


def worked_example() -> dict[str, list[list[str | None]]]:
    """Three students, one course, two evaluations, four weeks."""
    grades = {"E1": ("12", "13"), "E2": ("10", None), "E3": ("18", "18")}
    notas = [
        [student, "TBD", "2026-II", evaluation, "0.5", grade, "2026-10-01" if grade else None]
        for student, pair in grades.items()
        for evaluation, grade in zip(("EP", "EF"), pair)
    ]
    asistencia = [
        [student, "TBD", "2026-II", str(week), WEEKS[week - 1], state]
        for student, states in STATES.items()
        for week, state in enumerate(states, start=1)
    ]
    return {
        "semestres": [list(TERM)],
        "cursos": [list(COURSE)],
        "estudiantes": [list(s) for s in STUDENTS],
        "notas": notas,
        "asistencia": asistencia,
    }


def frames(spark, batch):
    """Bronze frames of a literal batch, numbered in row order."""
    out = {}
    for name, table in CONTRACTS.items():
        schema = ", ".join(f"{c} string" for c in table.columns) + f", {ROW} long"
        rows = [(*row, place) for place, row in enumerate(batch.get(name, []), start=2)]
        out[name] = spark.createDataFrame(rows, schema)
    return out


def write_csv(batch, folder) -> str:
    os.makedirs(folder, exist_ok=True)
    for name, table in CONTRACTS.items():
        with open(os.path.join(folder, f"{name}.csv"), "w", newline="", encoding="utf-8") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerow(table.columns)
            writer.writerows([["" if c is None else c for c in row] for row in batch[name]])
    return str(folder)


def published(spark, folder, table):
    """Rows of a published CSV table as dictionaries of text."""
    df = spark.read.option("header", True).option("escape", '"').csv(f"{folder}/{table}.csv")
    return [r.asDict() for r in df.collect()]
