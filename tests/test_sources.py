"""Reading: row numbers, normalisation, headers, limits, sizes."""

from __future__ import annotations

import os

import pytest
from batches import frames, worked_example, write_csv

from gradeflow.contract import CONTRACTS, contract
from gradeflow.operators import numbering
from gradeflow.operators.lookup import Limits
from gradeflow.operators.numbering import dealt_out, number_parquet
from gradeflow.sources.bronze import (
    describe,
    header_matches,
    limit_report,
    profile,
    read_bronze,
    read_csv,
    read_parquet,
)
from gradeflow.sources.star_schema import derive
from gradeflow.sources.workspace import Workspace, measure


def notas_lines(start: int, count: int) -> str:
    return "".join(f"E{n},C1,P1,EP,0.5,12,2026-10-01\n" for n in range(start, start + count))


def test_rows_of_a_split_file_are_numbered_in_order(spark, tmp_path):
    header = ",".join(CONTRACTS["notas"].columns) + "\n"
    lines = notas_lines(2, 20_000).splitlines(keepends=True)
    lines.insert(7, "\n")  # Blank lines are no records.
    (tmp_path / "notas.csv").write_text(header + "".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = read_csv(spark, str(tmp_path), "notas", Workspace(spark))
        wrong = df.filter("estudiante_id <> concat('E', fila)").count()
        assert (df.count(), wrong) == (20_000, 0)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_of_many_files_are_numbered_by_file_name(spark, tmp_path):
    header = ",".join(CONTRACTS["notas"].columns) + "\n"
    folder = tmp_path / "notas.csv"
    folder.mkdir()
    (folder / "part-b.csv").write_text(header + notas_lines(502, 3000))
    (folder / "part-a.csv").write_text(header + notas_lines(2, 500))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        df = read_csv(spark, str(tmp_path), "notas", Workspace(spark))
        assert df.filter("estudiante_id <> concat('E', fila)").count() == 0
        assert df.selectExpr("min(fila)", "max(fila)", "count(distinct fila)").first() == (2, 3501, 3500)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_parquet_rows_are_numbered_over_files(spark, tmp_path):
    for name, start in (("a", 2), ("b", 1002)):
        spark.range(start, start + 1000, 1, 1).write.parquet(f"{tmp_path}/t/{name}.parquet")
    parts = [f"{tmp_path}/t/{name}.parquet" for name in "ab"]
    df = number_parquet(spark.read.parquet(*parts))
    assert df.filter("id <> fila").count() == 0 and df.count() == 2000


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_bytes=0)])
def test_parquet_rows_are_never_gathered_by_file(spark, tmp_path, monkeypatch, limits):
    monkeypatch.setattr(numbering, "PART", 300)
    for name, start, count in (("a", 2, 1000), ("b", 1002, 0), ("c", 1002, 1), ("d", 1003, 900)):
        spark.range(start, start + count, 1, 1).write.parquet(f"{tmp_path}/t/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        df = number_parquet(spark.read.parquet(*[f"{tmp_path}/t/{name}.parquet" for name in "abcd"]), limits)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.filter("id <> fila").count() == 0 and df.count() == 1901
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Rows of a file meet in one task on neither way; counting reads no column.
    assert ("BroadcastHashJoin" in plan) == bool(limits.broadcast_bytes)
    assert ("_part" in plan) == (not limits.broadcast_bytes)
    assert "ReadSchema: struct<>" in plan


def test_rows_of_one_row_group_are_dealt_out(spark, tmp_path):
    """What follows has more tasks; the numbers stay; a scan of enough splits is not shuffled."""
    path = f"{tmp_path}/notas.parquet"
    columns = contract("notas").columns
    spark.range(2, 60002, 1, 1).selectExpr(*[f"sha2(id || '{c}', 256) as {c}" for c in columns]).write.parquet(path)
    df = read_parquet(spark, str(tmp_path), "notas")
    assert df.filter("estudiante_id <> sha2(fila || 'estudiante_id', 256)").count() == 0 and df.count() == 60000
    df.write.parquet(f"{tmp_path}/out")
    assert len(spark.read.parquet(f"{tmp_path}/out").inputFiles()) > 1
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        scan = spark.read.parquet(path)
        numbered = number_parquet(scan)
        assert dealt_out(numbered, scan) is numbered
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sizes_are_observed_while_tables_are_written(spark):
    workspace = Workspace(spark)
    df = spark.range(0, 1000, 1, 7).selectExpr("cast(id as string) as a", "if(id % 3 = 0, null, repeat('ñ', int(id % 40))) as b")
    for name, frame in (("all", df), ("none", df.filter("a = 'x'")), ("empty", df.limit(0)), ("sorted", df.orderBy("b"))):
        landed, size = workspace.land_sized(name, frame)
        assert size == measure(frame) == measure(landed)
    assert workspace.land_sized("one", df, ["a"])[1] == measure(df.select("a"))
    workspace.remove()


def test_cells_are_normalised(spark, tmp_path):
    batch = worked_example()
    batch["cursos"] = [["  TBD ", 'Nombre "citado", con coma', "V", "   ", "6", "D"]]
    bronze = read_bronze(spark, write_csv(batch, tmp_path))
    row = bronze["cursos"].first()
    assert (row["curso_id"], row["creditos"], row["fila"]) == ("TBD", None, 2)
    assert row["nombre"] == 'Nombre "citado", con coma'
    assert dict(bronze["notas"].dtypes)["peso"] == "string"


def test_short_and_long_records(spark, tmp_path):
    folder = write_csv(worked_example(), tmp_path)
    (tmp_path / "cursos.csv").write_text(
        ",".join(CONTRACTS["cursos"].columns) + "\nC1,N\nC2,N,V,4,6,D,extra\n"
    )
    rows = read_csv(spark, folder, "cursos", Workspace(spark)).collect()
    assert [(r["curso_id"], r["docente"]) for r in rows] == [("C1", None), ("C2", "D")]


def test_header_check(spark, tmp_path):
    folder = write_csv(worked_example(), tmp_path)
    assert header_matches(spark, folder, "cursos")
    path = tmp_path / "cursos.csv"
    path.write_text(path.read_text().replace("curso_id,nombre", "nombre,curso_id"))
    assert not header_matches(spark, folder, "cursos")
    read_csv(spark, folder, "cursos", Workspace(spark)).collect()
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, folder, "cursos", Workspace(spark), check_header=True).collect()


def test_profile_and_limits(spark):
    batch = worked_example()
    batch["cursos"][0][1] = "n" * 201
    bronze = frames(spark, batch)
    sizes = profile(bronze)
    assert describe(sizes) == "semestres 1, cursos 1, estudiantes 3, notas 6, asistencia 12"
    assert sizes["cursos"].bytes >= 201 and sizes["cursos"].widest == sizes["cursos"].bytes
    report = {r["tabla"]: r for r in limit_report(bronze).collect()}
    assert report["cursos"]["celda_mas_larga"] == 201
    assert not report["cursos"]["dentro_del_limite"] and report["notas"]["dentro_del_limite"]


def test_workspace_uses_the_shared_folder(spark):
    folder = Workspace(spark).folder
    assert folder.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_a_workspace_can_be_removed(spark):
    workspace = Workspace(spark)
    landed = workspace.land("t", spark.range(3))
    assert landed.count() == 3 and os.path.isdir(workspace.folder)
    workspace.remove()
    assert not os.path.exists(workspace.folder)


def test_facts_of_unknown_bytes_are_never_broadcast(spark):
    size = profile({"notas": derive(spark, "/root/testdata/sf0.001", "notas")})["notas"]
    assert size.rows > 0 and size.bytes is None
    assert not Limits().broadcasts(size)
