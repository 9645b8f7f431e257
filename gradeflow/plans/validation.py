"""Validation: rules per table, parents before children, rejects into quarantine.

Each table is checked against the *valid* rows of the tables it refers to, so a
rejected parent also rejects its children.  What is read more than once is written to
the workspace: the rows with the rules they break, which are read for counts, repeated
keys and marking, the repeated keys or a bit for each row that stays, and the checked rows
if neither can be broadcast.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.contract import CONTRACTS, FACTS, MASTERS, POLICY, REASONS, ROW, TableContract, contract
from gradeflow.functions.rules import (
    EMAIL,
    IS_VALID,
    any_missing,
    key_text,
    matches,
    not_positive,
    reasons,
    record_json,
    typed,
    unparsed,
)
from gradeflow.operators.duplicates import (
    blocks_bound,
    blocks_tell,
    mark_by_blocks,
    mark_duplicates,
    repeated_bound,
    repeated_keys,
    staying_rows,
)
from gradeflow.operators.lookup import DEFAULT_LIMITS, Limits, Size, attach, hot_keys
from gradeflow.sources.workspace import Workspace, free_shuffles, measure, side_by_side

Violations = list[tuple[str, str]]


def _semestres(t: TableContract, strict: bool) -> Violations:
    bad_date = f"{unparsed(t, 'fecha_inicio', strict)} or {unparsed(t, 'fecha_fin', strict)}"
    return [("NUMERO_INVALIDO", not_positive(t, "numero")), ("FECHA_INVALIDA", bad_date)]


_UNKNOWN_TERM = ("SEMESTRE_INEXISTENTE", "semestre_id is not null and semestre is null")


def _cursos(t: TableContract, strict: bool) -> Violations:
    bad_number = f"{not_positive(t, 'creditos')} or {not_positive(t, 'horas_semanales')}"
    return [("NUMERO_INVALIDO", bad_number), _UNKNOWN_TERM]


def _estudiantes(t: TableContract, strict: bool) -> Violations:
    return [("CORREO_INVALIDO", f"not {matches('correo', EMAIL)}"), _UNKNOWN_TERM]


# Rules every fact shares: its student and course exist and agree.
_ENROLMENT_RULES: Violations = [
    ("ESTUDIANTE_INEXISTENTE", "estudiante_id is not null and estudiante is null"),
    ("CURSO_INEXISTENTE", "curso_id is not null and curso is null"),
    ("CURSO_DE_OTRO_SEMESTRE", "estudiante.semestre_id <> curso.semestre_id"),
    ("PERIODO_INCONSISTENTE", "periodo <> curso.periodo"),
]


def _notas(t: TableContract, strict: bool) -> Violations:
    nota, peso = typed(t, "nota"), typed(t, "peso")
    return [
        ("NOTA_NO_NUMERICA", unparsed(t, "nota")),
        (
            "NOTA_FUERA_DE_RANGO",
            f"{nota} not between double({POLICY.min_score}) and double({POLICY.max_score})",
        ),
        (
            "PESO_INVALIDO",
            f"peso is not null and not coalesce({peso} > 0 and {peso} <= 1, false)",
        ),
        ("FECHA_INVALIDA", unparsed(t, "fecha_registro", strict)),
        *_ENROLMENT_RULES,
    ]


def _asistencia(t: TableContract, strict: bool) -> Violations:
    states = ", ".join(f"'{state}'" for state in POLICY.attendance_states)
    return [
        ("NUMERO_INVALIDO", not_positive(t, "semana")),
        ("FECHA_INVALIDA", unparsed(t, "fecha", strict)),
        (
            "FECHA_FUERA_DE_PERIODO",
            f"({typed(t, 'fecha', strict)}) not between curso.fecha_inicio and curso.fecha_fin",
        ),
        ("ESTADO_INVALIDO", f"{typed(t, 'estado')} not in ({states})"),
        *_ENROLMENT_RULES,
    ]


def term_reference(silver: dict[str, DataFrame]) -> DataFrame:
    """Valid terms by id."""
    return silver["semestres"].select("semestre_id", "periodo", "fecha_inicio", "fecha_fin")


def course_reference(silver: dict[str, DataFrame], terms_fit: bool) -> DataFrame:
    """Valid courses by id, with the period and dates of their term."""
    terms = term_reference(silver)
    courses = silver["cursos"].select("curso_id", "semestre_id")
    return courses.join(F.broadcast(terms) if terms_fit else terms, "semestre_id").select(
        "curso_id", "semestre_id", "periodo", "fecha_inicio", "fecha_fin"
    )


# What the reference of students holds; its size is theirs, not that of whole students.
STUDENT_REFERENCE = ("estudiante_id", "semestre_id")


def student_reference(silver: dict[str, DataFrame]) -> DataFrame:
    """Valid students by id, with their term."""
    return silver["estudiantes"].select(*STUDENT_REFERENCE)


@dataclass(frozen=True)
class Lookup:
    """A parent table a rule set needs: joined on ``key`` as the struct ``name``."""

    parent: str
    key: str
    name: str


@dataclass(frozen=True)
class TableRules:
    """How one table is checked: its parents and its rules in reporting order.

    The required-cells rule always comes first and the duplicate rule last.
    """

    violations: Callable[[TableContract, bool], Violations]
    lookups: tuple[Lookup, ...] = ()


_TERM = (Lookup("semestres", "semestre_id", "semestre"),)
_ENROLMENT = (
    Lookup("estudiantes", "estudiante_id", "estudiante"),
    Lookup("cursos", "curso_id", "curso"),
)

# Places for the cells of any table, in contract order.
CELLS = tuple(f"celda_{place}" for place in range(max(len(t.columns) for t in CONTRACTS.values())))

# Tables that do not refer to each other, parents first.
WAVES = (("semestres",), ("cursos", "estudiantes"), FACTS)

ACADEMIC_RULES: dict[str, TableRules] = {
    "semestres": TableRules(_semestres),
    "cursos": TableRules(_cursos, _TERM),
    "estudiantes": TableRules(_estudiantes, _TERM),
    "notas": TableRules(_notas, _ENROLMENT),
    "asistencia": TableRules(_asistencia, _ENROLMENT),
}


def to_silver(checked: DataFrame, table: TableContract, strict_dates: bool = False) -> DataFrame:
    """Valid rows with their Silver types."""
    cells = [f"{typed(table, c, strict_dates)} as {c}" for c in table.columns]
    return checked.filter(IS_VALID).selectExpr(*cells)


def rejected_rows(checked: DataFrame, table: TableContract) -> DataFrame:
    """Rejected rows as they are sorted: table, row, reasons, and the cells under their places."""
    cells = dict(zip(CELLS, table.columns))
    return checked.filter(f"not {IS_VALID}").selectExpr(
        f"'{table.name}' as tabla",
        ROW,
        REASONS,
        *[f"{cells.get(c, 'cast(null as string)')} as {c}" for c in CELLS],
    )


def to_quarantine(rejected: DataFrame) -> DataFrame:
    """Rejected rows of any table: where they came from, why, and the record as it was read.

    Key and record are texts made of the cells, so they are made last, by who writes them.
    """
    named = {t.name: dict(zip(t.columns, CELLS)) for t in CONTRACTS.values()}

    def by_table(text: Callable[[TableContract, dict[str, str]], str]) -> str:
        cases = [f"when '{t.name}' then {text(t, named[t.name])}" for t in CONTRACTS.values()]
        return f"case tabla {' '.join(cases)} end"

    return rejected.selectExpr(
        "tabla",
        ROW,
        f"{by_table(key_text)} as clave",
        REASONS,
        f"{by_table(record_json)} as registro",
    )


@dataclass
class Validation:
    """Checked tables with what follows from them."""

    checked: dict[str, DataFrame]
    silver: dict[str, DataFrame]
    sizes: dict[str, Size]
    flagged: dict[str, DataFrame] = field(default_factory=dict)

    def rejected(self) -> DataFrame:
        """Rejected rows of all tables, of which ``to_quarantine`` makes the quarantine."""
        parts = [rejected_rows(df, contract(name)) for name, df in self.checked.items()]
        return reduce(DataFrame.unionByName, parts)

    def quarantine(self, ordered: bool = True) -> DataFrame:
        rows = self.rejected()
        return to_quarantine(rows.orderBy("tabla", ROW) if ordered else rows)


def _reference(parent: str, silver: dict[str, DataFrame], sizes: dict[str, Size], limits: Limits):
    if parent == "semestres":
        return term_reference(silver), sizes["semestres"]
    if parent == "cursos":
        # A course carries its term's period and dates: at most one widest term each.
        terms, courses = sizes["semestres"], sizes["cursos"]
        if courses.bytes is None:
            return course_reference(silver, limits.broadcasts(terms)), courses
        bound = courses.bytes + courses.rows * terms.widest
        fits = limits.broadcasts(terms)
        return course_reference(silver, fits), Size(courses.rows, bound, courses.widest + terms.widest)
    return student_reference(silver), sizes["estudiantes"]


def flag(
    bronze: DataFrame,
    table: TableContract,
    rules: TableRules,
    silver: dict[str, DataFrame],
    sizes: dict[str, Size],
    strict_dates: bool = False,
    limits: Limits = DEFAULT_LIMITS,
) -> DataFrame:
    """Rows of one table with the codes of every rule they break but duplication."""
    looked = bronze.select(*table.columns, ROW)
    for lookup in rules.lookups:
        reference, size = _reference(lookup.parent, silver, sizes, limits)
        hot = None
        if not limits.broadcasts(size):
            rows = sizes[table.name].rows if table.name in sizes else bronze.count()
            hot = hot_keys(bronze, [lookup.key], rows)
        if reference.columns[0] != lookup.key:
            reference = reference.withColumnRenamed(reference.columns[0], lookup.key)
        looked = attach(looked, reference, [lookup.key], lookup.name, size=size, hot=hot, limits=limits)
    broken = [("CAMPO_REQUERIDO", any_missing(table.required)), *rules.violations(table, strict_dates)]
    return looked.selectExpr(*table.columns, ROW, f"{reasons(broken)} as {REASONS}")


def validate(
    bronze: dict[str, DataFrame],
    sizes: dict[str, Size] | None = None,
    *,
    rules: dict[str, TableRules] = ACADEMIC_RULES,
    tables: tuple[str, ...] = (*MASTERS, *FACTS),
    strict_dates: bool = False,
    limits: Limits = DEFAULT_LIMITS,
    workspace: Workspace | None = None,
) -> Validation:
    """Check ``tables`` of a batch, parents first.

    ``sizes`` are the measured table sizes (see ``profile``); those not given are observed
    while the table is written.  ``limits`` say what may be broadcast.  Tables
    are written to ``workspace``, or to one of their own.
    """
    bronze = {name: bronze[name] for name in CONTRACTS if name in tables}
    sizes = dict(sizes or {})
    result = Validation({}, {}, sizes)
    # What is known of a table besides its own size: that of the columns others look up.
    looked_up: dict[str, Size] = {}
    workspace = workspace or Workspace(next(iter(bronze.values())).sparkSession)

    def marked(name: str, table: TableContract, flagged: DataFrame, rows: int) -> tuple[DataFrame, DataFrame]:
        """All rows with the duplicates marked, and the clean ones alone."""
        # Among the clean rows of a key the first stays, whatever the others are.
        clean = flagged.filter(IS_VALID)
        if not limits.broadcasts(repeated_bound(table, rows)) and limits.broadcasts(blocks_bound(flagged)):
            blocks = workspace.land(f"staying/{name}", staying_rows(flagged, table))
            if blocks_tell(flagged, table, blocks):
                return mark_by_blocks(flagged, table, blocks), mark_by_blocks(clean, table, blocks)
        repeated, size = workspace.land_sized(f"repeated/{name}", repeated_keys(flagged, table))
        checked = mark_duplicates(flagged, table, rows, repeated, size, limits)
        # Written unless marking again is as cheap as reading: a broadcast lookup.
        if not limits.broadcasts(size):
            checked = workspace.land(f"checked/{name}", checked)
            return checked, checked
        return checked, mark_duplicates(clean, table, rows, repeated, size, limits)

    def check(name: str) -> None:
        table, unchecked, known = contract(name), bronze[name], sizes | looked_up
        references = [_reference(x.parent, result.silver, known, limits)[1] for x in rules[name].lookups]
        if name not in sizes and not all(limits.broadcasts(size) for size in references):
            # Frames may be queries of their own: rows and hot keys are not found by running them again.
            unchecked, own = workspace.land_sized(f"unchecked/{name}", unchecked.select(*table.columns, ROW), ())
            known = known | {name: Size(own.rows, None)}
        flagged = flag(unchecked, table, rules[name], result.silver, known, strict_dates, limits)
        # Facts are never broadcast, so only their rows are of use.
        measured = table.columns if name in MASTERS else ()
        flagged, own = workspace.land_sized(f"flagged/{name}", flagged, measured)
        if name == "estudiantes":
            looked_up[name] = measure(flagged.select(*STUDENT_REFERENCE))
        sizes.setdefault(name, own if name in MASTERS else Size(own.rows, None))
        checked, clean = marked(name, table, flagged, sizes[name].rows)
        result.flagged[name] = flagged
        result.checked[name] = checked
        result.silver[name] = to_silver(clean, table, strict_dates)

    for wave in WAVES:
        side_by_side({name: partial(check, name) for name in wave if name in bronze})
    for layer in (result.checked, result.silver, result.flagged, sizes):
        for name in bronze:
            layer[name] = layer.pop(name)
    # All that follows reads what was written.
    free_shuffles(workspace.spark)
    return result
