"""Each rule: broken, kept, and not applicable."""

from __future__ import annotations

import pytest
from batches import frames, worked_example

from gradeflow.contract import CONTRACTS, RULES, contract
from gradeflow.functions.rules import reasons
from gradeflow.plans.validation import validate

# One changed cell of the worked example, and the reasons that follow for its row.
CASES = [
    ("semestres", {"nombre": None}, "CAMPO_REQUERIDO"),
    ("semestres", {"numero": "0"}, "NUMERO_INVALIDO"),
    ("semestres", {"numero": "7.0"}, "NUMERO_INVALIDO"),
    ("semestres", {"numero": "x", "fecha_fin": "2026-02-30"}, "NUMERO_INVALIDO|FECHA_INVALIDA"),
    ("semestres", {"fecha_inicio": "17/08/2026"}, "FECHA_INVALIDA"),
    ("semestres", {"fecha_inicio": "2026-08"}, ""),
    ("semestres", {"numero": "+7"}, ""),
    ("cursos", {"docente": None}, "CAMPO_REQUERIDO"),
    ("cursos", {"creditos": "-1"}, "NUMERO_INVALIDO"),
    ("cursos", {"horas_semanales": "1e2"}, "NUMERO_INVALIDO"),
    ("cursos", {"semestre_id": "IX"}, "SEMESTRE_INEXISTENTE"),
    ("cursos", {"semestre_id": None}, "CAMPO_REQUERIDO"),
    ("estudiantes", {"correo": "no-arroba"}, "CORREO_INVALIDO"),
    ("estudiantes", {"correo": "a b@x.test"}, "CORREO_INVALIDO"),
    ("estudiantes", {"correo": "a@@x.test"}, "CORREO_INVALIDO"),
    ("estudiantes", {"correo": "a@xtest"}, "CORREO_INVALIDO"),
    ("estudiantes", {"correo": None, "semestre_id": "IX"}, "CAMPO_REQUERIDO|SEMESTRE_INEXISTENTE"),
    ("notas", {"nota": "quince"}, "NOTA_NO_NUMERICA"),
    ("notas", {"nota": "12,5"}, "NOTA_NO_NUMERICA"),
    ("notas", {"nota": "20.01"}, "NOTA_FUERA_DE_RANGO"),
    ("notas", {"nota": "NaN"}, "NOTA_FUERA_DE_RANGO"),
    ("notas", {"nota": "Infinity"}, "NOTA_FUERA_DE_RANGO"),
    ("notas", {"nota": "-0.5"}, "NOTA_FUERA_DE_RANGO"),
    ("notas", {"nota": "20"}, ""),
    ("notas", {"nota": None, "fecha_registro": None}, ""),
    ("notas", {"peso": "0"}, "PESO_INVALIDO"),
    ("notas", {"peso": "1.01"}, "PESO_INVALIDO"),
    ("notas", {"peso": "x"}, "PESO_INVALIDO"),
    ("notas", {"peso": "1"}, ""),
    ("notas", {"peso": None}, "CAMPO_REQUERIDO"),
    ("notas", {"fecha_registro": "2026-02-30"}, "FECHA_INVALIDA"),
    ("notas", {"estudiante_id": "E9"}, "ESTUDIANTE_INEXISTENTE"),
    ("notas", {"curso_id": "C9"}, "CURSO_INEXISTENTE"),
    ("notas", {"curso_id": "OTRO"}, "CURSO_DE_OTRO_SEMESTRE|PERIODO_INCONSISTENTE"),
    ("notas", {"periodo": "2026-I"}, "PERIODO_INCONSISTENTE"),
    ("notas", {"evaluacion": None}, "CAMPO_REQUERIDO"),
    (
        "notas",
        {"nota": "25", "peso": "2", "fecha_registro": "x", "estudiante_id": "E9", "curso_id": "C9"},
        "NOTA_FUERA_DE_RANGO|PESO_INVALIDO|FECHA_INVALIDA|ESTUDIANTE_INEXISTENTE|CURSO_INEXISTENTE",
    ),
    ("asistencia", {"semana": "0"}, "NUMERO_INVALIDO"),
    ("asistencia", {"fecha": "31/08/2026"}, "FECHA_INVALIDA"),
    ("asistencia", {"fecha": "2026-08-16"}, "FECHA_FUERA_DE_PERIODO"),
    ("asistencia", {"fecha": "2026-12-19"}, "FECHA_FUERA_DE_PERIODO"),
    ("asistencia", {"fecha": "2026-12-18"}, ""),
    ("asistencia", {"estado": "Z"}, "ESTADO_INVALIDO"),
    ("asistencia", {"estado": "p"}, ""),
    ("asistencia", {"estado": None}, "CAMPO_REQUERIDO"),
]


def changed_batch():
    """The worked example plus one changed row per case, each with its own key."""
    batch = worked_example()
    batch["semestres"].append(["I", "1", "Primer semestre", "2025-I", "2025-03-01", "2025-07-01"])
    batch["cursos"].append(["OTRO", "Otro curso", "I", "3", "4", "Docente Dos"])
    own_key = {"notas": "evaluacion", "asistencia": "semana"}
    expected = {}
    for place, (table, change, codes) in enumerate(CASES):
        columns = CONTRACTS[table].columns
        row = dict(zip(columns, batch[table][0]))
        if table in own_key:
            row[own_key[table]] = str(100 + place)
        else:
            row[CONTRACTS[table].key[0]] = f"K{place}"
        row.update(change)
        batch[table].append([row[c] for c in columns])
        expected[table, len(batch[table]) + 1] = codes
    return batch, expected


def test_every_rule(spark):
    batch, expected = changed_batch()
    result = validate(frames(spark, batch))
    for table, df in result.checked.items():
        found = {r["fila"]: r["motivos"] for r in df.collect()}
        for (name, row), codes in expected.items():
            if name == table:
                assert found[row] == codes, (table, row)
        for row, codes in found.items():
            if (table, row) not in expected:
                assert codes == "", (table, row)


def test_rejected_parent_rejects_children(spark):
    batch = worked_example()
    batch["semestres"][0][1] = "cero"
    result = validate(frames(spark, batch))
    codes = {t: {r["motivos"] for r in df.collect()} for t, df in result.checked.items()}
    assert codes["cursos"] == codes["estudiantes"] == {"SEMESTRE_INEXISTENTE"}
    assert codes["notas"] == {"ESTUDIANTE_INEXISTENTE|CURSO_INEXISTENTE"}
    assert codes["asistencia"] == {"ESTUDIANTE_INEXISTENTE|CURSO_INEXISTENTE"}


def test_silver_types_and_values(spark):
    batch = worked_example()
    batch["asistencia"][0][5] = "p"
    silver = validate(frames(spark, batch)).silver
    for name, table in CONTRACTS.items():
        assert dict(silver[name].dtypes) == table.types
        assert silver[name].columns == list(table.columns)
    assert silver["asistencia"].filter("estado = 'P'").count() == 7
    kept = validate(frames(spark, batch)).checked["asistencia"].filter("fila = 2").first()
    assert kept["estado"] == "p"


def test_strict_dates(spark):
    batch = worked_example()
    batch["notas"][0][6] = "2026-10"
    assert validate(frames(spark, batch)).quarantine().count() == 0
    strict = validate(frames(spark, batch), strict_dates=True)
    assert [r["motivos"] for r in strict.quarantine().collect()] == ["FECHA_INVALIDA"]


def test_first_clean_copy_stays(spark):
    batch = worked_example()
    clean = batch["notas"][0]
    bad = [*clean[:5], "99", clean[6]]
    no_key = [clean[0], clean[1], clean[2], None, *clean[4:]]
    batch["notas"] = [bad, clean, clean, bad, no_key, no_key]
    checked = validate(frames(spark, batch)).checked["notas"]
    assert {r["fila"]: r["motivos"] for r in checked.collect()} == {
        2: "NOTA_FUERA_DE_RANGO|REGISTRO_DUPLICADO",
        3: "",
        4: "REGISTRO_DUPLICADO",
        5: "NOTA_FUERA_DE_RANGO|REGISTRO_DUPLICADO",
        6: "CAMPO_REQUERIDO",
        7: "CAMPO_REQUERIDO",
    }


def test_first_copy_stays_when_none_is_clean(spark):
    batch = worked_example()
    bad = [*batch["notas"][0][:5], "99", None]
    batch["notas"] = [bad, bad]
    checked = validate(frames(spark, batch)).checked["notas"]
    assert {r["fila"]: r["motivos"] for r in checked.collect()} == {
        2: "NOTA_FUERA_DE_RANGO",
        3: "NOTA_FUERA_DE_RANGO|REGISTRO_DUPLICADO",
    }


def test_catalogue():
    assert len(RULES) == 15
    with pytest.raises(ValueError, match="unknown table"):
        contract("otra")
    with pytest.raises(ValueError, match="catalogue"):
        reasons([("NO_EXISTE", "true")])
