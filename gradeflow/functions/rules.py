"""SQL expressions the validation rules are made of.

A rule is a reason code plus a condition that is true when the row breaks it.  The
conditions are plain SQL over built-in functions, so all rules of a table are
evaluated in one projection inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable

from gradeflow.contract import (
    KEY_SEPARATOR,
    MISSING_KEY_PART,
    REASON_SEPARATOR,
    REASONS,
    RULES,
    TableContract,
)

# Fixed value: something@something.something without blanks or a second @.
EMAIL = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
# Fixed value: the strict form of a date cell.
ISO_DATE = r"^\d{4}-\d{2}-\d{2}$"

IS_VALID = f"({REASONS} = '')"


def matches(column: str, pattern: str) -> str:
    return f"{column} rlike r'{pattern}'"


def typed(contract: TableContract, column: str, strict_dates: bool = False) -> str:
    """Silver value of a text cell; null when the text does not parse.

    Date parsing follows Spark's cast ('2026-08' is the first of August).  With
    ``strict_dates`` only the full year-month-day form is accepted.
    """
    kind = contract.types[column]
    if column == "estado":
        return f"upper({column})"
    if kind == "string":
        return column
    if kind == "date" and strict_dates:
        return f"case when {matches(column, ISO_DATE)} then try_cast({column} as date) end"
    return f"try_cast({column} as {kind})"


def any_missing(columns: Iterable[str]) -> str:
    return "(" + " or ".join(f"{c} is null" for c in columns) + ")"


def all_present(columns: Iterable[str]) -> str:
    return "(" + " and ".join(f"{c} is not null" for c in columns) + ")"


def unparsed(contract: TableContract, column: str, strict_dates: bool = False) -> str:
    """A cell that has text but no typed value."""
    return f"({column} is not null and ({typed(contract, column, strict_dates)}) is null)"


def not_positive(contract: TableContract, column: str) -> str:
    """A cell that has text but is not an integer above zero."""
    return f"({column} is not null and not coalesce({typed(contract, column)} > 0, false))"


def reasons(violations: Iterable[tuple[str, str]]) -> str:
    """Codes of the broken rules in list order; '' for a row that breaks none.

    A condition that is null counts as not broken.
    """
    codes = []
    for code, broken in violations:
        if code not in RULES:
            raise ValueError(f"rule {code!r} is not in the catalogue")
        codes.append(f"case when {broken} then '{code}' end")
    return f"concat_ws('{REASON_SEPARATOR}', {', '.join(codes)})"


def key_text(contract: TableContract, named: dict[str, str] | None = None) -> str:
    """Natural key as readable text, with a mark for the missing parts.

    ``named`` says where cells have other names than in the contract.
    """
    named = named or {}
    parts = ", ".join(f"coalesce({named.get(c, c)}, '{MISSING_KEY_PART}')" for c in contract.key)
    return f"concat_ws('{KEY_SEPARATOR}', {parts})"


def record_json(contract: TableContract, named: dict[str, str] | None = None) -> str:
    """The row as it was read (normalised text), nulls kept, in contract order."""
    named = named or {}
    cells = ", ".join(f"{named.get(c, c)} as {c}" for c in contract.columns)
    return f"to_json(struct({cells}), map('ignoreNullFields', 'false'))"
