"""Every registered query against its SQL on the smallest driver tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import rows
from gradeflow import CONTRACTS, PERFORMANCE, GoldInputs, validate
from gradeflow.operators.lookup import Limits
from gradeflow.plans.quality import reason_counts
from gradeflow.sources.star_schema import academic_batch

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()
# The queries of a subpackage that may be absent have tests of their own.
OTHERS = {"pipeline", *(entry.llm.QUERIES if entry.llm else ())}
OWN = [name for name in entry.queries() if name not in OTHERS]


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"create view {view} as select * from read_parquet('{path}')")
    return connection


def expected(con, name):
    cursor = con.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    return sorted(names), rows(names, cursor.fetchall())


def test_every_query_has_sql():
    assert set(OWN) == set(SQL) - OTHERS


@pytest.mark.parametrize("name", OWN)
def test_query(spark, con, name):
    df = entry.queries()[name](spark, FOLDER)
    names, values = expected(con, name)
    assert sorted(df.columns) == names
    assert rows(df.columns, df.collect()) == values


def test_every_rule_of_every_table_rejects(spark):
    """And a rejected term takes its courses with it, a rejected course its grades."""
    checked = validate(academic_batch(spark, FOLDER)).checked
    fired = {(r["tabla"], r["motivo"]) for r in reason_counts(checked).filter("filas > 0").collect()}
    lookups = {"cursos": 1, "estudiantes": 1, "notas": 4, "asistencia": 4}
    assert len(fired) == 32 and {t for t, _ in fired} == set(CONTRACTS)
    parents = ("SEMESTRE_", "ESTUDIANTE_", "CURSO_", "PERIODO_")
    assert {t: sum(m.startswith(parents) for n, m in fired if n == t) for t in lookups} == lookups
    course = checked["cursos"].filter("curso_id = 'C22'").first()
    assert (course["semestre_id"], course["motivos"]) == ("S9", "SEMESTRE_INEXISTENTE")
    term = checked["semestres"].filter("semestre_id = 'S9'").first()
    assert term["motivos"] == "NUMERO_INVALIDO"
    grades = checked["notas"].filter("curso_id = 'C22'")
    assert grades.count() > 0 and grades.filter("motivos not like '%CURSO_INEXISTENTE%'").count() == 0


def test_paths_of_large_tables(spark, con):
    """Nothing broadcast, nothing ranked in a window: the same tables."""
    limits = Limits(broadcast_bytes=-1)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = validate(academic_batch(spark, FOLDER), limits=limits)
        for name, df in result.silver.items():
            assert rows(df.columns, df.collect()) == expected(con, f"silver_{name}")[1]
        inputs = GoldInputs(result.silver, result.sizes, limits)
        df = PERFORMANCE.build(inputs, "rendimiento")
        assert rows(df.columns, df.collect()) == expected(con, "gold_rendimiento")[1]
        quarantine = result.quarantine()
        assert rows(quarantine.columns, quarantine.collect()) == expected(con, "quarantine_rows")[1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["estudiante_id", "nombres", "apellidos"] and len(df.columns) == 24
    assert df.count() > 0
