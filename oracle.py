"""The same results in plain SQL, written independently of the Spark plans.

Each query is a chain of named steps over the driver's tables.  Rounded means and
ratios are computed with whole numbers, half up, so that they are exact.
"""

from __future__ import annotations

import re

from gradeflow.contract import CONTRACTS, DIMENSIONS, FACTS, RULES
from gradeflow.sources.star_schema import MAPPING

STEPS: dict[str, str] = {}


def half_up(numerator: str, denominator: str, digits: int) -> str:
    """numerator / denominator of non-negative whole numbers, rounded; null over 0."""
    scale = 10**digits
    top, bottom = f"CAST({numerator} AS HUGEINT)", f"CAST({denominator} AS HUGEINT)"
    return (
        f"CASE WHEN ({denominator}) <> 0 THEN CAST((2*{scale}*{top}+{bottom}) // (2*{bottom})"
        f" AS DOUBLE)/{scale}.0 END"
    )


def mean(column: str, digits: int) -> str:
    """Mean of values already rounded to ``digits``."""
    scale = 10**digits
    total = f"sum(CAST(round({column}*{scale}) AS BIGINT))"
    return half_up(total, f"({scale}*count({column}))", digits)


def tally(condition: str) -> str:
    return f"CAST(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS BIGINT)"


# --- Bronze -----------------------------------------------------------------

for _name, (_source, _join, _columns) in MAPPING.items():
    STEPS[f"{_name}_src"] = f"SELECT *, row_number() OVER () + 1 AS fila FROM {_source}"
    _cells = ", ".join(f"nullif(trim({sql}), '') AS {c}" for c, sql in _columns.items())
    _from = f"{_name}_src" + (f" JOIN {_join[0]} ON {_join[1]}" if _join else "")
    STEPS[f"{_name}_b"] = f"SELECT {_cells}, fila FROM {_from}"


# --- Validation ---------------------------------------------------------------


def _reasons(*rules: tuple[str, str]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{code}' END" for code, condition in rules)
    return f"concat_ws('|', {cases})"


def _not_positive(column: str) -> str:
    return f"({column} IS NOT NULL AND coalesce(try_cast({column} AS INT) <= 0, true))"


def _no_parse(column: str, kind: str) -> str:
    return f"({column} IS NOT NULL AND try_cast({column} AS {kind}) IS NULL)"


def _required(name: str) -> tuple[str, str]:
    return "CAMPO_REQUERIDO", " OR ".join(f"{c} IS NULL" for c in _qualified_required(name))


def _qualified_required(name: str) -> list[str]:
    return [f"b.{c}" for c in CONTRACTS[name].required]


_FACT_RULES = (
    ("ESTUDIANTE_INEXISTENTE", "b.estudiante_id IS NOT NULL AND e.estudiante_id IS NULL"),
    ("CURSO_INEXISTENTE", "b.curso_id IS NOT NULL AND c.curso_id IS NULL"),
    ("CURSO_DE_OTRO_SEMESTRE", "e.semestre_id <> c.semestre_id"),
    ("PERIODO_INCONSISTENTE", "b.periodo <> c.periodo"),
)
_FACT_JOIN = (
    " LEFT JOIN estudiantes_s e ON b.estudiante_id = e.estudiante_id"
    " LEFT JOIN course_ref c ON b.curso_id = c.curso_id"
)
_TERM_JOIN = " LEFT JOIN semestres_s s ON b.semestre_id = s.semestre_id"
_NO_TERM = ("SEMESTRE_INEXISTENTE", "b.semestre_id IS NOT NULL AND s.semestre_id IS NULL")

_CHECKS: dict[str, tuple[str, list[tuple[str, str]]]] = {
    "semestres": (
        "",
        [
            ("NUMERO_INVALIDO", _not_positive("b.numero")),
            (
                "FECHA_INVALIDA",
                f"{_no_parse('b.fecha_inicio', 'DATE')} OR {_no_parse('b.fecha_fin', 'DATE')}",
            ),
        ],
    ),
    "cursos": (
        _TERM_JOIN,
        [
            (
                "NUMERO_INVALIDO",
                f"{_not_positive('b.creditos')} OR {_not_positive('b.horas_semanales')}",
            ),
            _NO_TERM,
        ],
    ),
    "estudiantes": (
        _TERM_JOIN,
        [
            (
                "CORREO_INVALIDO",
                r"NOT regexp_full_match(b.correo, '[^@\s]+@[^@\s]+\.[^@\s]+')",
            ),
            _NO_TERM,
        ],
    ),
    "notas": (
        _FACT_JOIN,
        [
            ("NOTA_NO_NUMERICA", _no_parse("b.nota", "DOUBLE")),
            (
                "NOTA_FUERA_DE_RANGO",
                "try_cast(b.nota AS DOUBLE) < 0 OR try_cast(b.nota AS DOUBLE) > 20",
            ),
            (
                "PESO_INVALIDO",
                "b.peso IS NOT NULL AND NOT coalesce(try_cast(b.peso AS DOUBLE) > 0"
                " AND try_cast(b.peso AS DOUBLE) <= 1, false)",
            ),
            ("FECHA_INVALIDA", _no_parse("b.fecha_registro", "DATE")),
            *_FACT_RULES,
        ],
    ),
    "asistencia": (
        _FACT_JOIN,
        [
            ("NUMERO_INVALIDO", _not_positive("b.semana")),
            ("FECHA_INVALIDA", _no_parse("b.fecha", "DATE")),
            (
                "FECHA_FUERA_DE_PERIODO",
                "try_cast(b.fecha AS DATE) < c.fecha_inicio"
                " OR try_cast(b.fecha AS DATE) > c.fecha_fin",
            ),
            ("ESTADO_INVALIDO", "upper(b.estado) NOT IN ('P','T','F','J')"),
            *_FACT_RULES,
        ],
    ),
}

for _name, (_joins, _rules) in _CHECKS.items():
    _t = CONTRACTS[_name]
    _cols = ", ".join(f"b.{c}" for c in _t.columns)
    STEPS[f"{_name}_f"] = (
        f"SELECT {_cols}, b.fila, {_reasons(_required(_name), *_rules)} AS previos"
        f" FROM {_name}_b b{_joins}"
    )
    _key = ", ".join(_t.key)
    _complete = " AND ".join(f"{c} IS NOT NULL" for c in _t.key)
    STEPS[f"{_name}_c"] = (
        f"SELECT {', '.join(_t.columns)}, fila, concat_ws('|', nullif(previos, ''),"
        f" CASE WHEN {_complete} AND puesto > 1 THEN 'REGISTRO_DUPLICADO' END) AS motivos"
        f" FROM (SELECT *, row_number() OVER (PARTITION BY {_key}"
        f" ORDER BY CASE WHEN previos = '' THEN 0 ELSE 1 END, fila) AS puesto FROM {_name}_f)"
    )
    _typed = ", ".join(
        f"upper({c}) AS {c}"
        if c == "estado"
        else (c if kind == "string" else f"CAST({c} AS {kind.upper()}) AS {c}")
        for c, kind in _t.types.items()
    )
    STEPS[f"{_name}_s"] = f"SELECT {_typed} FROM {_name}_c WHERE motivos = ''"

STEPS["course_ref"] = (
    "SELECT cu.curso_id, cu.semestre_id, se.periodo, se.fecha_inicio, se.fecha_fin"
    " FROM cursos_s cu JOIN semestres_s se ON cu.semestre_id = se.semestre_id"
)
STEPS["rejected"] = " UNION ALL ".join(
    f"SELECT '{name}' AS tabla, fila, "
    + " || ' · ' || ".join(f"coalesce({c}, '?')" for c in t.key)
    + " AS clave, motivos, CAST(json_object("
    + ", ".join(f"'{c}', {c}" for c in t.columns)
    + f") AS VARCHAR) AS registro FROM {name}_c WHERE motivos <> ''"
    for name, t in CONTRACTS.items()
)

# --- Quality --------------------------------------------------------------------

STEPS["counts"] = " UNION ALL ".join(
    f"SELECT '{name}' AS tabla, {place} AS lugar, count(*) AS recibidas,"
    " coalesce(CAST(sum(CASE WHEN motivos = '' THEN 1 ELSE 0 END) AS BIGINT), 0) AS aceptadas,"
    " coalesce(CAST(sum(CASE WHEN motivos <> '' THEN 1 ELSE 0 END) AS BIGINT), 0) AS rechazadas"
    f" FROM {name}_c"
    for place, name in enumerate(CONTRACTS)
)
STEPS["reason_rows"] = (
    "SELECT tabla, motivo, count(*) AS filas FROM"
    " (SELECT tabla, unnest(string_split(motivos, '|')) AS motivo FROM rejected) GROUP BY ALL"
)
_rule_rows = ", ".join(f"('{c}', '{d}', '{t}')" for c, (d, t) in RULES.items())
STEPS["rules"] = f"SELECT * FROM (VALUES {_rule_rows}) r(motivo, dimension, descripcion)"
_dimension_rows = ", ".join(f"('{d}', {i})" for i, d in enumerate(DIMENSIONS, start=1))
STEPS["dimensions"] = f"SELECT * FROM (VALUES {_dimension_rows}) d(dimension, orden)"
_SHARE = "CASE WHEN recibidas = 0 THEN 1.0 ELSE CAST(rechazadas AS DOUBLE)/recibidas END"
_PERCENT = (
    "CASE WHEN recibidas = 0 THEN 10000 ELSE"
    " (2*10000*rechazadas + recibidas) // (2*recibidas) END"
)
STEPS["checks"] = (
    "SELECT 'Rechazo en ' || tabla AS control, (" + _SHARE + ") <= 0.05 AS aprobado,"
    " rechazadas || ' de ' || recibidas || ' filas rechazadas (' ||"
    f" (({_PERCENT}) // 100) || '.' || lpad(CAST(({_PERCENT}) % 100 AS VARCHAR), 2, '0') ||"
    " ' %); máximo 5.00 %' AS detalle FROM counts"
    " UNION ALL SELECT 'Tabla maestra ' || tabla || ' con datos válidos', aceptadas > 0,"
    " aceptadas || ' filas válidas' FROM counts"
    " WHERE tabla IN ('semestres', 'cursos', 'estudiantes')"
    " UNION ALL SELECT 'Conservación de filas', sum(recibidas) = sum(aceptadas) + sum(rechazadas),"
    " 'recibidas = aceptadas + rechazadas (' || CAST(sum(recibidas) AS BIGINT) || ' = ' ||"
    " CAST(sum(aceptadas) AS BIGINT) || ' + ' || CAST(sum(rechazadas) AS BIGINT) || ')' FROM counts"
)
STEPS["totals"] = (
    "SELECT CAST(sum(recibidas) AS BIGINT) AS recibidas, CAST(sum(aceptadas) AS BIGINT)"
    " AS aceptadas, CAST(sum(rechazadas) AS BIGINT) AS rechazadas FROM counts"
)

# --- Gold: performance ---------------------------------------------------------

STEPS["matriculas"] = (
    "SELECT e.estudiante_id, e.nombres, e.apellidos, e.seccion, e.semestre_id, s.periodo,"
    " c.curso_id, c.nombre AS curso, c.docente, c.creditos"
    " FROM estudiantes_s e JOIN cursos_s c ON e.semestre_id = c.semestre_id"
    " JOIN semestres_s s ON e.semestre_id = s.semestre_id"
)
# Grades and weights in millionths, their products in 10^-12.
STEPS["por_nota"] = (
    "SELECT estudiante_id, curso_id, periodo, count(*) AS evaluaciones,"
    " count(nota) AS evaluaciones_registradas,"
    " sum(CAST(round(peso*1e6) AS HUGEINT)) AS peso_u,"
    " sum(CASE WHEN nota IS NOT NULL THEN CAST(round(peso*1e6) AS HUGEINT) ELSE 0 END) AS peso_reg_u,"
    " sum(CAST(round(nota*1e6) AS HUGEINT)*CAST(round(peso*1e6) AS HUGEINT)) AS puntaje_u"
    " FROM notas_s GROUP BY ALL"
)
STEPS["por_asistencia"] = (
    "SELECT estudiante_id, curso_id, periodo, count(*) AS sesiones, "
    + ", ".join(
        f"{tally(f'estado = {chr(39)}{s}{chr(39)}')} AS {alias}"
        for s, alias in (
            ("P", "presentes"),
            ("T", "tardanzas"),
            ("F", "faltas"),
            ("J", "justificadas"),
        )
    )
    + " FROM asistencia_s GROUP BY ALL"
)
STEPS["medidas"] = (
    "SELECT m.*, coalesce(n.evaluaciones, 0) AS evaluaciones,"
    " coalesce(n.evaluaciones, 0) - coalesce(n.evaluaciones_registradas, 0) AS evaluaciones_pendientes,"
    f" {half_up('puntaje_u', '(peso_reg_u*1000000)', 2)} AS promedio,"
    " CASE WHEN n.evaluaciones > 0 AND n.evaluaciones = n.evaluaciones_registradas"
    " AND abs(peso_u - 1000000) < 1"
    " THEN CAST((puntaje_u + 500001000000) // 1000000000000 AS INT) END AS nota_final,"
    + ", ".join(
        f" coalesce(a.{c}, 0) AS {c}"
        for c in ("sesiones", "presentes", "tardanzas", "faltas", "justificadas")
    )
    + f", {half_up('(a.presentes+a.tardanzas)', '(a.sesiones-a.justificadas)', 4)} AS asistencia_pct,"
    f" {half_up('a.faltas', 'a.sesiones', 4)} AS inasistencia_pct,"
    " coalesce(CAST(a.faltas AS DOUBLE)/a.sesiones > CAST(0.30 AS DOUBLE), false) AS excedido"
    " FROM matriculas m LEFT JOIN por_nota n USING (estudiante_id, curso_id, periodo)"
    " LEFT JOIN por_asistencia a USING (estudiante_id, curso_id, periodo)"
)
STEPS["marcas"] = (
    "SELECT *, coalesce(coalesce(nota_final, promedio) < 13, false) AS bajo,"
    " coalesce(inasistencia_pct >= CAST(0.20 AS DOUBLE), false) AS riesgo FROM medidas"
)
STEPS["rendimiento"] = (
    "SELECT estudiante_id, nombres, apellidos, seccion, semestre_id, periodo, curso_id, curso,"
    " docente, creditos, evaluaciones, evaluaciones_pendientes, promedio, nota_final, sesiones,"
    " presentes, tardanzas, faltas, justificadas, asistencia_pct, inasistencia_pct,"
    " CASE WHEN excedido THEN 'INHABILITADO' WHEN nota_final IS NULL THEN 'PENDIENTE'"
    " WHEN nota_final >= 13 THEN 'APROBADO' ELSE 'DESAPROBADO' END AS condicion,"
    " bajo OR excedido OR riesgo AS requiere_atencion,"
    " concat_ws('; ', CASE WHEN bajo THEN 'Promedio menor a 13' END,"
    " CASE WHEN excedido THEN 'Inasistencias mayores al 30 %' END,"
    " CASE WHEN riesgo AND NOT excedido THEN 'Inasistencias en riesgo' END,"
    " CASE WHEN evaluaciones_pendientes > 0 THEN 'Evaluaciones pendientes' END) AS alertas"
    " FROM marcas"
)

_CONDITIONS = ", ".join(
    f"{tally(f'condicion = {chr(39)}{c}{chr(39)}')} AS {alias}"
    for c, alias in (
        ("APROBADO", "aprobados"),
        ("DESAPROBADO", "desaprobados"),
        ("INHABILITADO", "inhabilitados"),
    )
)
_PENDING = f"{tally(f'condicion = {chr(39)}PENDIENTE{chr(39)}')} AS pendientes"
_RATE = (
    "CASE WHEN aprobados + desaprobados > 0 THEN "
    + half_up("aprobados", "(aprobados+desaprobados+inhabilitados)", 4)
    + " END AS tasa_aprobacion"
)
_CORR = (
    "CASE WHEN isnan(corr(asistencia_pct, promedio)) THEN NULL"
    " ELSE round(corr(asistencia_pct, promedio), 4) END AS correlacion_asistencia_nota"
)

STEPS["cursos_resumen"] = (
    f"SELECT *, {_RATE} FROM (SELECT curso_id, curso, docente, creditos, periodo,"
    f" count(*) AS matriculados, {_CONDITIONS}, {_PENDING}, {mean('promedio', 2)} AS media,"
    " quantile_disc(promedio, 0.5) AS mediana, min(promedio) AS promedio_minimo,"
    " max(promedio) AS promedio_maximo, round(stddev_samp(promedio), 2) AS desviacion,"
    f" {mean('asistencia_pct', 4)} AS asistencia_promedio, {_CORR},"
    f" {tally('requiere_atencion')} AS requieren_atencion"
    " FROM rendimiento GROUP BY curso_id, curso, docente, creditos, periodo)"
)
STEPS["alumnos"] = (
    "SELECT estudiante_id, nombres, apellidos, seccion, semestre_id, periodo, count(*) AS cursos,"
    f" {_CONDITIONS}, {_PENDING}, CAST(sum(creditos) AS BIGINT) AS creditos_matriculados,"
    " CAST(sum(CASE WHEN condicion = 'APROBADO' THEN creditos ELSE 0 END) AS BIGINT)"
    " AS creditos_aprobados, "
    + half_up(
        "sum(CAST(round(promedio*100) AS BIGINT)*creditos)",
        "(100*sum(CASE WHEN promedio IS NOT NULL THEN creditos END))",
        2,
    )
    + f" AS promedio_ponderado, {mean('asistencia_pct', 4)} AS asistencia_promedio"
    " FROM rendimiento GROUP BY ALL"
)

# --- Gold: alerts ----------------------------------------------------------------

STEPS["alertas"] = (
    "SELECT e.estudiante_id, e.nombres, e.apellidos, e.seccion, c.curso_id, c.nombre AS curso,"
    " a.periodo, a.sesiones, a.faltas, a.justificadas,"
    f" {half_up('a.faltas', 'a.sesiones', 4)} AS inasistencia_pct,"
    " CAST(floor(a.sesiones*CAST(0.30 AS DOUBLE)) AS BIGINT) AS faltas_permitidas,"
    " greatest(CAST(floor(a.sesiones*CAST(0.30 AS DOUBLE)) AS BIGINT) - a.faltas, 0)"
    " AS faltas_restantes,"
    " CASE WHEN CAST(a.faltas AS DOUBLE)/a.sesiones > CAST(0.30 AS DOUBLE) THEN 'INHABILITADO'"
    " WHEN CAST(a.faltas AS DOUBLE)/a.sesiones >= CAST(0.20 AS DOUBLE) THEN 'EN_RIESGO'"
    " ELSE 'NORMAL' END AS nivel"
    " FROM por_asistencia a JOIN estudiantes_s e ON a.estudiante_id = e.estudiante_id"
    " JOIN cursos_s c ON a.curso_id = c.curso_id"
)
_LEVELS = ", ".join(
    f"{tally(f'nivel = {chr(39)}{level}{chr(39)}')} AS {alias}"
    for level, alias in (
        ("INHABILITADO", "inhabilitados"),
        ("EN_RIESGO", "en_riesgo"),
        ("NORMAL", "normales"),
    )
)


def _finals() -> dict[str, str]:
    """The last SELECT of each query."""
    out: dict[str, str] = {}
    for name, t in CONTRACTS.items():
        out[f"bronze_{name}"] = f"SELECT * FROM {name}_b"
        out[f"reasons_{name}"] = f"SELECT {', '.join(t.key)}, fila, motivos FROM {name}_c"
        out[f"silver_{name}"] = f"SELECT * FROM {name}_s"
    for name in ("notas", "asistencia"):
        key = ", ".join(CONTRACTS[name].key)
        out[f"repeated_keys_{name}"] = (
            f"SELECT {key}, count(*) AS copias, coalesce(min(CASE WHEN previos = '' THEN fila END),"
            f" min(fila)) AS conserva FROM {name}_f WHERE "
            + " AND ".join(f"{c} IS NOT NULL" for c in CONTRACTS[name].key)
            + f" GROUP BY {key} HAVING count(*) > 1"
        )
    out["bronze_counts"] = " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS filas FROM {name}_b" for name in CONTRACTS
    )
    out["bronze_limits"] = " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, filas, bytes, celda_mas_larga, filas <= 200000 AND bytes <="
        " 20971520 AND celda_mas_larga <= 200 AS dentro_del_limite FROM (SELECT count(*) AS filas,"
        " CAST(coalesce(sum("
        + " + ".join(f"coalesce(strlen({c}), 0)" for c in t.columns)
        + "), 0) AS BIGINT) AS bytes, CAST(coalesce(max(greatest("
        + ", ".join(f"coalesce(length({c}), 0)" for c in t.columns)
        + f")), 0) AS INT) AS celda_mas_larga FROM {name}_b)"
        for name, t in CONTRACTS.items()
    )
    out["reference_terms"] = (
        "SELECT semestre_id, periodo, fecha_inicio, fecha_fin FROM semestres_s"
    )
    out["reference_courses"] = "SELECT * FROM course_ref"
    out["reference_students"] = "SELECT estudiante_id, semestre_id FROM estudiantes_s"
    out["quarantine_rows"] = "SELECT * FROM rejected"
    out["table_counts"] = "SELECT tabla, recibidas, aceptadas, rechazadas FROM counts"
    out["reason_counts"] = "SELECT * FROM reason_rows"
    out["reason_quality"] = (
        "SELECT tabla, motivo, dimension, descripcion, filas FROM reason_rows JOIN rules USING (motivo)"
    )
    out["dimension_totals"] = (
        "SELECT d.dimension, d.orden, coalesce(CAST(sum(filas) AS BIGINT), 0) AS filas"
        " FROM dimensions d LEFT JOIN rules r ON d.dimension = r.dimension"
        " LEFT JOIN reason_rows c ON r.motivo = c.motivo GROUP BY ALL"
    )
    rate = (
        "CASE WHEN recibidas = 0 THEN 1.0 ELSE " + half_up("rechazadas", "recibidas", 6) + " END"
    )
    out["table_quality"] = (
        f"SELECT tabla, recibidas, aceptadas, rechazadas, {rate} AS tasa_rechazo,"
        f" ({_SHARE}) <= 0.05 AS dentro_tolerancia FROM counts"
    )
    out["gate_checks"] = "SELECT * FROM checks"
    verdict = "(SELECT bool_and(aprobado) FROM checks)"
    out["gate_decision"] = (
        f"SELECT recibidas, aceptadas, rechazadas, {rate} AS tasa_rechazo,"
        f" CAST(0.05 AS DOUBLE) AS tolerancia, {verdict} AS publicado, CASE WHEN {verdict} THEN"
        " 'Publicado: las filas válidas pasan a Gold y las observadas quedan en cuarentena' ELSE"
        " 'Bloqueado: Gold no se publica porque el lote no cumple los controles de calidad' END"
        " AS decision FROM totals"
    )
    out["stage_rows"] = (
        "SELECT 'BRONZE' AS etapa, tabla, recibidas AS filas FROM counts"
        " UNION ALL SELECT 'QUARANTINE', tabla, rechazadas FROM counts"
        " UNION ALL SELECT 'SILVER', tabla, aceptadas FROM counts"
    )
    # With a tolerance of one only empty masters would block.
    out["batch_result"] = (
        "SELECT (SELECT bool_and(aceptadas > 0) FROM counts WHERE lugar < 3) AS publicado, recibidas,"
        " aceptadas, rechazadas, CAST(1.0 AS DOUBLE) AS tolerancia, "
        + half_up("rechazadas", "recibidas", 6)
        + " AS tasa_rechazo, (SELECT count(*) FROM alertas) AS filas_gold FROM totals"
    )
    out["enrolments"] = "SELECT * FROM matriculas"
    out["grades_by_enrolment"] = (
        "SELECT estudiante_id, curso_id, periodo, evaluaciones, evaluaciones_registradas,"
        " CAST(peso_u AS DOUBLE)/1000000 AS peso_total,"
        " CAST(peso_reg_u AS DOUBLE)/1000000 AS peso_registrado,"
        " CAST(puntaje_u AS DOUBLE)/1000000000000 AS puntaje FROM por_nota"
    )
    out["attendance_by_enrolment"] = "SELECT * FROM por_asistencia"
    out["gold_rendimiento"] = "SELECT * FROM rendimiento"
    out["period_rendimiento"] = "SELECT * FROM rendimiento WHERE periodo = 'P2'"
    out["gold_cursos_resumen"] = "SELECT * RENAME (media AS promedio) FROM cursos_resumen"
    out["gold_estudiantes_resumen"] = (
        "SELECT *, CASE WHEN desaprobados + inhabilitados >= 2 THEN 'ALTO'"
        " WHEN desaprobados + inhabilitados = 1 THEN 'MEDIO' ELSE 'BAJO' END AS riesgo,"
        " CAST(rank() OVER (PARTITION BY semestre_id, periodo ORDER BY promedio_ponderado DESC"
        " NULLS LAST) AS INT) AS orden_merito,"
        " rank() OVER (PARTITION BY semestre_id, periodo ORDER BY promedio_ponderado DESC NULLS LAST)"
        " <= ceil(count(*) OVER (PARTITION BY semestre_id, periodo)/3.0) AS tercio_superior"
        " FROM alumnos"
    )
    out["gold_secciones_resumen"] = (
        f"SELECT * RENAME (media AS promedio), {_RATE} FROM (SELECT seccion, curso_id, curso,"
        f" count(DISTINCT estudiante_id) AS estudiantes, {mean('promedio', 2)} AS media,"
        f" {_CONDITIONS}, {mean('asistencia_pct', 4)} AS asistencia_promedio"
        " FROM rendimiento GROUP BY seccion, curso_id, curso)"
    )
    out["gold_evaluaciones_resumen"] = (
        "SELECT curso_id, nombre AS curso, evaluacion, peso, programadas, registradas,"
        " programadas - registradas AS pendientes, media AS promedio, aprobados,"
        f" {half_up('aprobados', 'registradas', 4)} AS tasa_aprobacion, fecha FROM"
        " (SELECT curso_id, evaluacion, min(peso) AS peso, count(*) AS programadas,"
        " count(nota) AS registradas, "
        + half_up("sum(CAST(round(nota*1e6) AS HUGEINT))", "(1000000*count(nota))", 2)
        + f" AS media, {tally('nota >= 13')} AS aprobados, min(fecha_registro) AS fecha"
        " FROM notas_s GROUP BY curso_id, evaluacion)"
        " JOIN (SELECT curso_id, nombre FROM cursos_s) USING (curso_id)"
    )
    out["gold_distribucion_notas"] = (
        "SELECT curso_id, curso, rango, orden, count(*) AS estudiantes FROM (SELECT curso_id, curso,"
        " CASE WHEN promedio IS NULL THEN 'Sin notas' WHEN promedio < 11 THEN '00-10'"
        " WHEN promedio < 13 THEN '11-12' WHEN promedio < 17 THEN '13-16' ELSE '17-20' END AS rango,"
        " CASE WHEN promedio IS NULL THEN 5 WHEN promedio < 11 THEN 1 WHEN promedio < 13 THEN 2"
        " WHEN promedio < 17 THEN 3 ELSE 4 END AS orden FROM rendimiento) GROUP BY ALL"
    )
    out["gold_asistencia_semanal"] = (
        "SELECT curso_id, nombre AS curso, semana, fecha, registros, asistieron, faltas, justificadas,"
        f" {half_up('asistieron', '(registros-justificadas)', 4)} AS asistencia_pct FROM"
        " (SELECT curso_id, semana, min(fecha) AS fecha, count(*) AS registros,"
        f" {tally(chr(39).join(['estado IN (', 'P', ',', 'T', ')']))} AS asistieron,"
        f" {tally(chr(39).join(['estado = ', 'F', '']))} AS faltas,"
        f" {tally(chr(39).join(['estado = ', 'J', '']))} AS justificadas"
        " FROM asistencia_s GROUP BY curso_id, semana)"
        " JOIN (SELECT curso_id, nombre FROM cursos_s) USING (curso_id)"
    )
    out["gold_resumen"] = (
        f"SELECT *, {_RATE}, 13 AS nota_aprobatoria, CAST(0.3 AS DOUBLE) AS maximo_inasistencia FROM"
        " (SELECT count(DISTINCT estudiante_id) AS estudiantes, count(DISTINCT curso_id) AS cursos,"
        f" count(*) AS matriculas, {_CONDITIONS}, {_PENDING}, {mean('promedio', 2)} AS promedio_general,"
        f" {mean('asistencia_pct', 4)} AS asistencia_promedio,"
        f" {tally('requiere_atencion')} AS requieren_atencion, {_CORR}, min(periodo) AS periodo"
        " FROM rendimiento)"
    )
    out["alertas_asistencia"] = "SELECT * FROM alertas"
    out["alertas_por_curso"] = (
        f"SELECT curso_id, curso, count(*) AS matriculas, {_LEVELS},"
        f" {mean('inasistencia_pct', 4)} AS inasistencia_promedio FROM alertas GROUP BY curso_id, curso"
    )
    out["alertas_resumen"] = (
        f"SELECT count(*) AS matriculas, count(DISTINCT estudiante_id) AS estudiantes, {_LEVELS},"
        " count(DISTINCT CASE WHEN nivel <> 'NORMAL' THEN estudiante_id END) AS estudiantes_con_alerta,"
        f" {mean('inasistencia_pct', 4)} AS inasistencia_promedio, min(periodo) AS periodo,"
        " CAST(0.3 AS DOUBLE) AS maximo_inasistencia, CAST(0.2 AS DOUBLE) AS umbral_riesgo FROM alertas"
    )
    for name in FACTS:
        out[f"csv_bronze_{name}"] = out[f"bronze_{name}"]
    in_order = "SELECT *, row_number() OVER (ORDER BY {}) AS posicion FROM ({})"
    out["published_rendimiento"] = in_order.format(
        "curso_id, apellidos, nombres, estudiante_id, periodo", out["gold_rendimiento"]
    )
    severity = "CASE nivel WHEN 'INHABILITADO' THEN 0 WHEN 'EN_RIESGO' THEN 1 ELSE 2 END"
    out["published_alertas_asistencia"] = in_order.format(
        f"{severity}, inasistencia_pct DESC, estudiante_id, curso_id, periodo",
        out["alertas_asistencia"],
    )
    out["published_alertas_por_curso"] = in_order.format(
        "inhabilitados DESC, en_riesgo DESC, curso_id", out["alertas_por_curso"]
    )
    out["published_rechazados"] = (
        "SELECT tabla, fila, motivos, row_number() OVER (ORDER BY tabla, fila) AS posicion FROM rejected"
    )
    counted = [("quarantine", "rechazados", "SELECT * FROM rejected")]
    counted += [("silver", name, f"SELECT * FROM {name}_s") for name in CONTRACTS]
    counted += [("gold", name, out[name]) for name in ("alertas_asistencia", "alertas_por_curso")]
    out["published_tables"] = " UNION ALL ".join(
        f"SELECT '{stage}' AS etapa, '{name}' AS tabla, count(*) AS filas_parquet,"
        f" count(*) AS filas_csv FROM ({sql})"
        for stage, name, sql in counted
    )
    out["gate_effect"] = (
        "SELECT 'quarantine' AS etapa, 1 AS tablas UNION ALL SELECT 'silver', 5"
        " UNION ALL SELECT 'gold', 2 WHERE (SELECT bool_and(aprobado) FROM checks)"
    )
    out["published_resumen"] = out["alertas_resumen"]
    # The first of two runs publishes, the second only if the gate passes.
    gold = " UNION ALL ".join(
        f"SELECT 'GOLD' AS etapa, '{name}' AS tabla, {{}} AS corridas, count(*) AS minimo,"
        f" count(*) AS maximo FROM ({out[name]})"
        for name in ("alertas_asistencia", "alertas_por_curso")
    ).replace("{}", "1 + (SELECT CAST(bool_and(aprobado) AS BIGINT) FROM checks)")
    out["run_metrics"] = (
        "SELECT etapa, tabla, CAST(2 AS BIGINT) AS corridas, filas AS minimo, filas AS maximo"
        f" FROM ({out['stage_rows']}) UNION ALL {gold}"
    )
    out["gate_checks_added"] = (
        "SELECT * FROM checks UNION ALL SELECT 'Cursos con notas', count(*) = 0, CAST(count(*) AS VARCHAR)"
        " FROM cursos_s WHERE curso_id NOT IN (SELECT curso_id FROM notas_s)"
        " UNION ALL SELECT 'Motivos distintos', count(*) <= 20, CAST(count(*) AS VARCHAR)"
        " FROM reason_rows WHERE filas > 0"
    )
    out["csv_headers"] = " UNION ALL ".join(
        f"SELECT '{name}' AS tabla, count(*) AS filas, true AS en_orden, false AS cambiado FROM {name}_b"
        for name in CONTRACTS
    )
    out["csv_cells_lineitem"] = _csv(
        {
            "l_orderkey": "whole",
            "l_partkey": "whole",
            "l_suppkey": "whole",
            "l_linenumber": "whole",
            "l_quantity": "double",
            "l_extendedprice": "double",
            "l_discount": "double",
            "l_tax": "double",
            "l_returnflag": "text",
            "l_linestatus": "text",
            "l_shipdate": "whole",
        },
        "lineitem",
    )
    out["csv_cells_documents"] = _csv(
        {"doc_id": "whole", "text": "text", "lang": "text", "source": "text", "n_chars": "whole"},
        "documents",
    )
    return out


def _csv(columns: dict[str, str], table: str) -> str:
    """Published text: plain numbers, guarded text, everything else as it prints."""
    cells = []
    for c, kind in columns.items():
        if kind == "double":
            # The values neither are tiny nor huge, so none prints an exponent.
            cells.append(f"regexp_replace(CAST({c} AS VARCHAR), '\\.0$', '') AS {c}")
        elif kind == "text":
            risky = f"left({c}, 1) IN ('=', '+', '-', '@', chr(9), chr(13))"
            cells.append(f"CASE WHEN {risky} THEN chr(39) || {c} ELSE {c} END AS {c}")
        else:
            cells.append(f"CAST({c} AS VARCHAR) AS {c}")
    return f"SELECT {', '.join(cells)} FROM {table}"


def with_steps(final: str) -> str:
    """Prepend the steps a statement needs, each after the ones it needs itself."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for word in re.findall(r"\b(?:FROM|JOIN)\s+(\w+)", sql):
            if word in STEPS and word not in needed:
                visit(STEPS[word])
                if word not in needed:
                    needed.append(word)

    visit(final)
    if not needed:
        return final
    steps = ", ".join(f"{name} AS MATERIALIZED ({STEPS[name]})" for name in needed)
    return f"WITH {steps} {final}"


def statements() -> dict[str, str]:
    return {name: with_steps(final) for name, final in _finals().items()}
