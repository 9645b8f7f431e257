"""An academic batch derived from a star schema of orders and events.

The mapping is SQL text that reads the same in Spark and in other engines, so an
independent engine can derive the same batch and check the results.  Defects are
planted by remainders of the source keys; nothing is left out.  Every rule of every
table is broken by some row; term S9 and courses C20 to C22 are rejected, and with them
the students and courses, grades and attendance that refer to them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradeflow.contract import ROW
from gradeflow.operators.numbering import dealt_out, number_parquet
from gradeflow.sources.bronze import cell

# The source columns that are used, with their types: nothing is inferred.
SOURCES = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey long, c_name string, c_mktsegment string",
    "orders": "o_orderkey long, o_custkey long",
    "lineitem": (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double,"
        " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string",
}

# Per table: the numbered source, what it is joined with, and column -> expression.
MAPPING: dict[str, tuple[str, tuple[str, str] | None, dict[str, str]]] = {
    "semestres": (
        "nation",
        None,
        {
            "semestre_id": (
                "case when n_nationkey=5 then null when n_nationkey=6 then 'S4'"
                " else 'S'||n_nationkey end"
            ),
            "numero": "case when n_nationkey=9 then '0' else cast(n_nationkey+1 as string) end",
            "nombre": "n_name",
            "periodo": "case when n_nationkey%5=4 then 'P2' else 'P1' end",
            "fecha_inicio": "'2024-01-03'",
            "fecha_fin": "case when n_nationkey=7 then '2024-02-31' else '2024-01-28' end",
        },
    ),
    "cursos": (
        "nation",
        None,
        {
            "curso_id": "case when n_nationkey=24 then 'C23' else 'C'||n_nationkey end",
            "nombre": "case when n_nationkey=20 then null else n_name end",
            "semestre_id": "case when n_nationkey=22 then 'S9' else 'S'||n_regionkey end",
            "creditos": "case when n_nationkey=21 then '0' else cast(2+n_nationkey%3 as string) end",
            "horas_semanales": "cast(3+n_nationkey%4 as string)",
            "docente": "'D'||(n_nationkey%7)",
        },
    ),
    "estudiantes": (
        "customer",
        None,
        {
            "estudiante_id": "'E'||(case when c_custkey%79=13 then c_custkey-1 else c_custkey end)",
            "nombres": "c_name",
            "apellidos": "case when c_custkey%97=5 then null else c_name end",
            "correo": "case when c_custkey%89=7 then 'sin-arroba' else 'u'||c_custkey||'@x.test' end",
            "semestre_id": "case when c_custkey%83=11 then 'S9' else 'S'||(c_custkey%5) end",
            "seccion": "c_mktsegment",
        },
    ),
    "notas": (
        "lineitem",
        ("orders", "l_orderkey=o_orderkey"),
        {
            "estudiante_id": "'E'||o_custkey",
            "curso_id": (
                "case when l_partkey%211=3 then 'C99'"
                " when l_partkey%199=4 then 'C'||((o_custkey+1)%5)"
                " else 'C'||(o_custkey%5+5*(l_orderkey%5)) end"
            ),
            "periodo": (
                "case when l_suppkey%61=2 and l_linenumber=1 then 'P0'"
                " when o_custkey%5=4 then 'P2' else 'P1' end"
            ),
            "evaluacion": (
                "case when l_partkey%197=5 then null when (l_partkey+l_suppkey)%4=0 then 'EC1'"
                " when (l_partkey+l_suppkey)%4=1 then 'EP' when (l_partkey+l_suppkey)%4=2 then 'EC2'"
                " else 'EF' end"
            ),
            "peso": (
                "case when l_partkey%307=9 then '1.5' when l_partkey%311=1 then 'x' else '0.25' end"
            ),
            "nota": (
                "case when l_returnflag='N' and l_linestatus='F' then null"
                " when l_partkey%101=1 then 'quince' when l_partkey%103=2 then '25'"
                " else cast(cast(floor(cast(l_quantity as int)*4/10) as int) as string)"
                "||'.'||cast((cast(l_quantity as int)*4)%10 as string) end"
            ),
            "fecha_registro": (
                "case when l_partkey%107=3 then '2024-02-31'"
                " else cast(cast(l_shipdate as date) as string) end"
            ),
        },
    ),
    "asistencia": (
        "events",
        None,
        {
            "estudiante_id": "'E'||user_id",
            "curso_id": (
                "case when event_id%179=6 then 'C'||((user_id+1)%5)"
                " else 'C'||(user_id%5+5*(event_id%5)) end"
            ),
            "periodo": (
                "case when event_id%181=7 then 'P0' when user_id%5=4 then 'P2' else 'P1' end"
            ),
            "semana": (
                "case when event_id%151=1 then '0' when event_id%157=2 then 'x'"
                " else cast(cast(floor((extract(day from ts)+1)/2) as int) as string) end"
            ),
            "fecha": (
                "case when event_id%163=3 then '31/01/2024'"
                " else cast(cast(ts as date) as string) end"
            ),
            "estado": (
                "case when event_id%173=5 then null when event_id%167=4 then 'X' when event_type='view' then 'p'"
                " when event_type='purchase' then 'P' when event_type='click' then 'T'"
                " when event_type='error' then 'F' else 'J' end"
            ),
        },
    ),
}


def _read(spark: SparkSession, folder: str, source: str) -> DataFrame:
    return spark.read.schema(SOURCES[source]).parquet(f"{folder}/{source}.parquet")


def derive(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Bronze of one table; its row number is the position in the source table."""
    source, join, columns = MAPPING[name]
    scan = _read(spark, folder, source)
    rows = dealt_out(number_parquet(scan), scan)
    if join:
        other, condition = join
        left, right = condition.split("=")
        parent = _read(spark, folder, other)
        rows = rows.join(parent, rows[left] == parent[right])
    return rows.selectExpr(*[cell(sql, column) for column, sql in columns.items()], ROW)


def academic_batch(
    spark: SparkSession, folder: str, tables: tuple[str, ...] = tuple(MAPPING)
) -> dict[str, DataFrame]:
    return {name: derive(spark, folder, name) for name in tables}
