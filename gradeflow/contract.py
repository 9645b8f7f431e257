"""What the engine is told about the data: tables, policy and rule catalogue.

Everything here is plain data.  The plans read it; nothing in it runs Spark.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

ROW = "fila"
REASONS = "motivos"


@dataclass(frozen=True)
class TableContract:
    """Columns of one input table in file order, with the type Silver gives them."""

    name: str
    description: str
    types: dict[str, str]
    key: tuple[str, ...]
    optional: frozenset[str] = frozenset()

    @property
    def columns(self) -> tuple[str, ...]:
        return tuple(self.types)

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(c for c in self.types if c not in self.optional)

    def text_schema(self) -> T.StructType:
        """Bronze schema: every column nullable text, never inferred."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.types])


@dataclass(frozen=True)
class Policy:
    """Grading policy and upload limits."""

    min_score: float
    max_score: float
    passing_score: int
    max_absence_ratio: float
    risk_absence_ratio: float
    default_tolerance: float
    attendance_states: tuple[str, ...]
    max_rows_per_table: int
    max_bytes_per_table: int
    max_cell_length: int
    rules_version: str


# Table names, column names and order, types, keys, optional columns.
CONTRACTS: dict[str, TableContract] = {
    c.name: c
    for c in (
        TableContract(
            "semestres",
            "Semestres de la carrera con su periodo y fechas",
            {
                "semestre_id": "string",
                "numero": "int",
                "nombre": "string",
                "periodo": "string",
                "fecha_inicio": "date",
                "fecha_fin": "date",
            },
            ("semestre_id",),
        ),
        TableContract(
            "cursos",
            "Cursos de la malla curricular",
            {
                "curso_id": "string",
                "nombre": "string",
                "semestre_id": "string",
                "creditos": "int",
                "horas_semanales": "int",
                "docente": "string",
            },
            ("curso_id",),
        ),
        TableContract(
            "estudiantes",
            "Estudiantes matriculados por semestre",
            {
                "estudiante_id": "string",
                "nombres": "string",
                "apellidos": "string",
                "correo": "string",
                "semestre_id": "string",
                "seccion": "string",
            },
            ("estudiante_id",),
        ),
        TableContract(
            "notas",
            "Evaluaciones de los estudiantes por curso",
            {
                "estudiante_id": "string",
                "curso_id": "string",
                "periodo": "string",
                "evaluacion": "string",
                "peso": "double",
                "nota": "double",
                "fecha_registro": "date",
            },
            ("estudiante_id", "curso_id", "periodo", "evaluacion"),
            frozenset({"nota", "fecha_registro"}),
        ),
        TableContract(
            "asistencia",
            "Asistencia de los estudiantes por curso y semana",
            {
                "estudiante_id": "string",
                "curso_id": "string",
                "periodo": "string",
                "semana": "int",
                "fecha": "date",
                "estado": "string",
            },
            ("estudiante_id", "curso_id", "periodo", "semana"),
        ),
    )
}

# The three tables the two fact tables refer to, parents first.
MASTERS = ("semestres", "cursos", "estudiantes")
FACTS = ("notas", "asistencia")

# Grade scale, thresholds, states, declared upload limits, version.
POLICY = Policy(
    min_score=0.0,
    max_score=20.0,
    passing_score=13,
    max_absence_ratio=0.30,
    risk_absence_ratio=0.20,
    default_tolerance=0.05,
    attendance_states=("P", "T", "F", "J"),
    max_rows_per_table=200_000,
    max_bytes_per_table=20 * 1024 * 1024,
    max_cell_length=200,
    rules_version="2.0.0",
)

# Quality dimensions.
DIMENSIONS = ("COMPLETITUD", "VALIDEZ", "UNICIDAD", "INTEGRIDAD", "CONSISTENCIA")

# Rule code -> (dimension, description), the texts as published.
RULES: dict[str, tuple[str, str]] = {
    "CAMPO_REQUERIDO": ("COMPLETITUD", "Falta un valor obligatorio"),
    "NOTA_NO_NUMERICA": ("VALIDEZ", "La nota no es un número"),
    "NOTA_FUERA_DE_RANGO": ("VALIDEZ", "La nota esta fuera de la escala 0 a 20"),
    "PESO_INVALIDO": ("VALIDEZ", "El peso de la evaluacion debe de ser mayor a 0 y menor o igual a 1"),
    "ESTADO_INVALIDO": ("VALIDEZ", "El estado de asistencia debe de ser P, T, F o J"),
    "FECHA_INVALIDA": ("VALIDEZ", "La fecha no tiene el formato AAAA-MM-DD válido"),
    "NUMERO_INVALIDO": ("VALIDEZ", "Un valor número entero no es válido o no es positivo"),
    "CORREO_INVALIDO": ("VALIDEZ", "El correo no es correcto"),
    "REGISTRO_DUPLICADO": ("UNICIDAD", "La clave del registro ya existe"),
    "SEMESTRE_INEXISTENTE": ("INTEGRIDAD", "El semestre no existe en la tabla de semestres"),
    "ESTUDIANTE_INEXISTENTE": ("INTEGRIDAD", "El estudiante no existe en el registro"),
    "CURSO_INEXISTENTE": ("INTEGRIDAD", "El curso no existe en el registro"),
    "CURSO_DE_OTRO_SEMESTRE": ("CONSISTENCIA", "El curso no pertenece al semestre del estudiante"),
    "PERIODO_INCONSISTENTE": ("CONSISTENCIA", "El periodo no coincide con el semestre del curso"),
    "FECHA_FUERA_DE_PERIODO": ("CONSISTENCIA", "La fechja esta fuera del inicio y fin del semestre"),
}

# Enrolment conditions and absence levels.
APROBADO = "APROBADO"
DESAPROBADO = "DESAPROBADO"
INHABILITADO = "INHABILITADO"
PENDIENTE = "PENDIENTE"
EN_RIESGO = "EN_RIESGO"
NORMAL = "NORMAL"

# Separators of published text columns.
REASON_SEPARATOR = "|"
KEY_SEPARATOR = " · "
MISSING_KEY_PART = "?"


def contract(table: str) -> TableContract:
    """Contract of a table; an unknown name is an error that lists the known ones."""
    try:
        return CONTRACTS[table]
    except KeyError:
        raise ValueError(f"unknown table {table!r}; known tables: {', '.join(CONTRACTS)}") from None
