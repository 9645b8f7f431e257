"""Whole runs from files to published tables."""

from __future__ import annotations

import json
import time

import pytest
from batches import frames, published, worked_example, write_csv

from gradeflow import ALERTS, CONTRACTS, PERFORMANCE, current_run, read_silver, rebuild, run_batch
from gradeflow.operators.lookup import Limits
from gradeflow.plans import validation
from gradeflow.plans.batch import add_pointer
from gradeflow.sources.workspace import create_once, free_shuffles, side_by_side


def test_performance_example(spark, tmp_path):
    inputs = write_csv(worked_example(), tmp_path / "in")
    result = run_batch(spark, inputs, str(tmp_path / "out"), PERFORMANCE, 0.05)
    assert result.published
    assert (result.received, result.accepted, result.rejected) == (23, 23, 0)
    assert result.gold_rows == 3 and result.files == 15
    rows = spark.read.parquet(f"{result.folder}/gold/rendimiento.parquet").collect()
    by_student = {r["estudiante_id"]: r for r in rows}
    e1, e2, e3 = (by_student[e] for e in ("E1", "E2", "E3"))
    assert (e1["promedio"], e1["nota_final"]) == (12.5, 13)
    assert (e1["asistencia_pct"], e1["inasistencia_pct"]) == (0.75, 0.25)
    assert e1["condicion"] == "APROBADO" and e1["requiere_atencion"]
    assert e1["alertas"] == "Inasistencias en riesgo"
    assert (e2["promedio"], e2["nota_final"], e2["condicion"]) == (10.0, None, "PENDIENTE")
    assert (e2["asistencia_pct"], e2["inasistencia_pct"]) == (1.0, 0.0)
    assert e2["alertas"] == "Promedio menor a 13; Evaluaciones pendientes"
    assert (e3["promedio"], e3["nota_final"], e3["condicion"]) == (18.0, 18, "INHABILITADO")
    assert (e3["asistencia_pct"], e3["inasistencia_pct"]) == (0.5, 0.5)
    assert e3["alertas"] == "Inasistencias mayores al 30 %"
    assert [r["estudiante_id"] for r in published(spark, f"{result.folder}/gold", "rendimiento")] == [
        "E3",
        "E2",
        "E1",
    ]
    course = published(spark, f"{result.folder}/gold", "cursos_resumen")[0]
    assert (course["aprobados"], course["pendientes"], course["inhabilitados"]) == ("1", "1", "1")
    assert course["promedio"] == "13.5" and course["tasa_aprobacion"] == "0.5"
    summary = spark.read.option("multiLine", True).json(f"{result.folder}/gold/resumen.json").first()
    assert (summary["estudiantes"], summary["matriculas"], summary["periodo"]) == (3, 3, "2026-II")
    assert summary["nota_aprobatoria"] == 13 and summary["maximo_inasistencia"] == 0.3
    assert current_run(spark, str(tmp_path / "out")) == result.folder
    silver = read_silver(spark, result.folder)
    assert silver["notas"].count() == 6
    assert dict(silver["notas"].dtypes)["peso"] == "double"


def test_alert_example(spark, tmp_path):
    inputs = write_csv(worked_example(), tmp_path / "in")
    result = run_batch(spark, inputs, str(tmp_path / "out"), ALERTS, 0.05)
    rows = published(spark, f"{result.folder}/gold", "alertas_asistencia")
    assert [
        (r["estudiante_id"], r["nivel"], r["faltas_permitidas"], r["faltas_restantes"]) for r in rows
    ] == [("E3", "INHABILITADO", "1", "0"), ("E1", "EN_RIESGO", "1", "0"), ("E2", "NORMAL", "1", "1")]
    by_course = published(spark, f"{result.folder}/gold", "alertas_por_curso")
    assert by_course == [
        {
            "curso_id": "TBD",
            "curso": "Talleres de Big Data",
            "matriculas": "3",
            "inhabilitados": "1",
            "en_riesgo": "1",
            "normales": "1",
            "inasistencia_promedio": "0.25",
        }
    ]
    summary = spark.read.option("multiLine", True).json(f"{result.folder}/gold/resumen.json").first()
    assert (summary["matriculas"], summary["estudiantes_con_alerta"]) == (3, 2)
    assert summary["umbral_riesgo"] == 0.2


def dirty():
    batch = worked_example()
    batch["estudiantes"] += [
        ["E4", "Dan", None, "dan@x.test", "V", "B"],
        ["E1", "Ana", "Otra", "ana2@x.test", "V", "A"],
    ]
    batch["notas"] += [["E4", "TBD", "2026-II", "EP", "0.5", "15", None]]
    return batch


def test_gate_blocks_gold_only(spark, tmp_path):
    inputs = write_csv(dirty(), tmp_path / "in")
    blocked = run_batch(spark, inputs, str(tmp_path / "out"), PERFORMANCE, 0.01, run_id="one")
    assert not blocked.published and blocked.gold_rows == 0
    assert not (tmp_path / "out/one/gold").exists()
    rejected = published(spark, f"{blocked.folder}/quarantine", "rechazados")
    assert [(r["tabla"], r["fila"], r["clave"], r["motivos"]) for r in rejected] == [
        ("estudiantes", "5", "E4", "CAMPO_REQUERIDO"),
        ("estudiantes", "6", "E1", "REGISTRO_DUPLICADO"),
        ("notas", "8", "E4 · TBD · 2026-II · EP", "ESTUDIANTE_INEXISTENTE"),
    ]
    record = json.loads(rejected[0]["registro"])
    assert list(record) == ["estudiante_id", "nombres", "apellidos", "correo", "semestre_id", "seccion"]
    assert record["apellidos"] is None
    assert read_silver(spark, blocked.folder)["estudiantes"].count() == 3
    report = spark.read.json(f"{blocked.folder}/quality.json").first()
    assert report["publicado"] is False and report["recibidas"] == 26 and report["rechazadas"] == 3
    assert {d["dimension"]: d["filas"] for d in report["dimensiones"]} == {
        "COMPLETITUD": 1,
        "VALIDEZ": 0,
        "UNICIDAD": 1,
        "INTEGRIDAD": 1,
        "CONSISTENCIA": 0,
    }
    assert len(report["controles"]) == 9 and len(report["motivos"]) == 3
    passed = run_batch(spark, inputs, str(tmp_path / "out"), PERFORMANCE, 0.5, run_id="two")
    assert passed.published and passed.gold_rows == 3
    metrics = spark.read.json(f"{tmp_path}/out/metrics.json")
    assert {r["run_id"] for r in metrics.select("run_id").collect()} == {"one", "two"}
    assert current_run(spark, str(tmp_path / "out")).endswith("/two")
    # A blocked run leaves the pointer alone, and a run id serves once.
    run_batch(spark, inputs, str(tmp_path / "out"), PERFORMANCE, 0.01, run_id="three")
    assert current_run(spark, str(tmp_path / "out")).endswith("/two")
    with pytest.raises(FileExistsError, match="two"):
        run_batch(spark, inputs, str(tmp_path / "out"), PERFORMANCE, 0.01, run_id="two")
    assert (tmp_path / "out/two/gold").exists()
    manifest = spark.read.json(f"{tmp_path}/out/two/manifest.json").collect()
    assert {r["etapa"] for r in manifest} >= {"silver", "gold", "quarantine", "quality.json"}


def test_a_run_that_breaks_off_is_not_current(spark, tmp_path):
    inputs, output = write_csv(worked_example(), tmp_path / "in"), str(tmp_path / "out")
    with pytest.raises(FileNotFoundError):
        current_run(spark, output)
    run_batch(spark, inputs, output, ALERTS, run_id="good")

    def broken(df, path):
        raise OSError("no space")

    with pytest.raises(OSError, match="no space"):
        run_batch(spark, inputs, output, ALERTS, run_id="bad", formats={"csv": broken})
    assert current_run(spark, output).endswith("/good")


def test_same_results_when_nothing_fits(spark, tmp_path):
    """The paths of large tables give what the paths of small ones give."""
    inputs = write_csv(dirty(), tmp_path / "in")
    tight = Limits(broadcast_bytes=-1)
    small = run_batch(spark, inputs, str(tmp_path / "a"), PERFORMANCE, 0.5)
    large = run_batch(spark, inputs, str(tmp_path / "b"), PERFORMANCE, 0.5, limits=tight)
    tables = [f"gold/{t.name}" for t in PERFORMANCE.all_tables()] + ["quarantine/rechazados"]
    for table in tables:
        a = spark.read.parquet(f"{small.folder}/{table}.parquet")
        b = spark.read.parquet(f"{large.folder}/{table}.parquet")
        assert a.schema == b.schema
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())), table


def test_parquet_input(spark, tmp_path):
    batch = dirty()
    from batches import frames

    for name, df in frames(spark, batch).items():
        df.drop("fila").coalesce(1).write.parquet(f"{tmp_path}/in/{name}.parquet")
    result = run_batch(spark, f"{tmp_path}/in", f"{tmp_path}/out", ALERTS, 0.5, fmt="parquet")
    assert result.published and result.rejected == 3 and result.gold_rows == 3


def test_extension_points(spark, tmp_path):
    """A further rule, check and format are plain arguments."""
    from pyspark.sql import functions as F

    from gradeflow.plans.validation import ACADEMIC_RULES, TableRules
    from gradeflow.sinks.publish import FORMATS

    lookups = ACADEMIC_RULES["estudiantes"].lookups
    section = TableRules(lambda t, strict: [("NUMERO_INVALIDO", "seccion = 'B'")], lookups)
    result = run_batch(
        spark,
        write_csv(worked_example(), tmp_path / "in"),
        str(tmp_path / "out"),
        ALERTS,
        1.0,
        rules={**ACADEMIC_RULES, "estudiantes": section},
        extra_checks=[
            lambda seen: seen.counts.filter("tabla = 'notas'").select(
                F.lit("Notas suficientes").alias("control"),
                (F.col("aceptadas") >= 6).alias("aprobado"),
                F.lit("").alias("detalle"),
            ),
            # A check on the contents of Silver: every course has a grade.
            lambda seen: seen.silver["cursos"]
            .join(seen.silver["notas"], "curso_id", "left_anti")
            .agg(
                F.lit("Cursos con notas").alias("control"),
                (F.count(F.lit(1)) == 0).alias("aprobado"),
                F.lit("").alias("detalle"),
            ),
            lambda seen: seen.reasons.agg(
                F.lit("Pocos motivos").alias("control"),
                (F.coalesce(F.max("filas"), F.lit(0)) < 1).alias("aprobado"),
                F.lit("").alias("detalle"),
            ),
        ],
        formats={**FORMATS, "orc": lambda df, path: df.write.orc(f"{path}.orc")},
    )
    # E3 of section B and with it two grades and four sessions are rejected.
    assert (result.published, result.rejected) == (False, 7)
    report = spark.read.json(f"{result.folder}/quality.json").first()
    failed = {c["control"] for c in report["controles"] if not c["aprobado"]}
    assert failed == {"Notas suficientes", "Pocos motivos"}
    assert "Cursos con notas" in {c["control"] for c in report["controles"]}
    assert spark.read.orc(f"{result.folder}/silver/notas.orc").count() == 4
    stored = spark.read.json(f"{result.folder}/result.json").first()
    assert (stored["received"], stored["rejected"], stored["published"]) == (23, 7, False)


def test_missing_table_is_named(spark, tmp_path):
    folder = write_csv(worked_example(), tmp_path / "in")
    (tmp_path / "in/notas.csv").unlink()
    with pytest.raises(FileNotFoundError, match="notas.*" + folder):
        run_batch(spark, folder, str(tmp_path / "out"), ALERTS)


@pytest.mark.parametrize("tolerance", [-0.1, 1.1, float("nan"), float("inf")])
def test_tolerance_is_checked(spark, tmp_path, tolerance):
    with pytest.raises(ValueError):
        run_batch(spark, str(tmp_path), str(tmp_path / "out"), ALERTS, tolerance)


def test_published_runs_are_numbered_by_who_is_first(spark, tmp_path):
    out = str(tmp_path / "out")
    made = side_by_side({f"r{i}": lambda i=i: add_pointer(spark, out, f"r{i}") for i in range(6)})
    assert sorted(made.values()) == [1, 2, 3, 4, 5, 6]
    # The last number is current, whatever the clock of the driver that made it.
    assert current_run(spark, out) == f"{out}/{max(made, key=made.get)}"
    assert add_pointer(spark, out, "later") == 7 and current_run(spark, out).endswith("/later")


def test_a_run_id_goes_to_one_of_several(spark, tmp_path):
    path = str(tmp_path / "run" / "_run")
    made = side_by_side({str(i): lambda: create_once(spark, path, "x") for i in range(6)})
    assert sorted(made.values()) == [False] * 5 + [True]
    with pytest.raises(FileExistsError, match="exists already"):
        run_batch(spark, write_csv(worked_example(), tmp_path / "in"), str(tmp_path), ALERTS, run_id="run")


def two_periods():
    """The worked example twice, the second time in another term and period."""
    batch = worked_example()
    for name, rows in batch.items():
        columns = CONTRACTS[name].columns
        own = {"semestre_id", "curso_id", "estudiante_id"} & set(columns)
        for row in list(rows):
            cells = dict(zip(columns, row))
            cells |= {c: f"{cells[c]}b" for c in own}
            if "periodo" in cells:
                cells["periodo"] = "2027/I = x"
            rows.append([cells[c] for c in columns])
    return batch


def test_shuffle_files_go_once_all_is_checked(spark, tmp_path, monkeypatch):
    """Spark keeps them until the driver's garbage is collected, which nothing else asks for."""

    def shuffles():
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = [files.apply(i).getName() for i in range(files.size())]
        return {name.split("_")[1] for name in names if name.startswith("shuffle_")}

    freed = []
    monkeypatch.setattr(validation, "free_shuffles", freed.append)
    result = validation.validate(frames(spark, worked_example()))
    assert freed == [spark] and list(result.checked) == list(CONTRACTS)
    before = shuffles()
    spark.range(100).repartition(3, "id").write.parquet(str(tmp_path / "t"))
    made = shuffles() - before
    end = time.time() + 30
    while (left := made & shuffles()) and time.time() < end:
        free_shuffles(spark)
        time.sleep(0.2)
    assert made and not left
    assert result.silver["notas"].count() == 6


def test_one_period_reads_its_own_files(spark, tmp_path):
    inputs = write_csv(two_periods(), tmp_path / "in")
    result = run_batch(spark, inputs, str(tmp_path / "out"), PERFORMANCE, 0.05)
    assert result.published and result.rejected == 0
    later = read_silver(spark, result.folder, "2027/I = x")
    assert later["notas"].columns == list(CONTRACTS["notas"].columns)
    assert (later["notas"].count(), later["asistencia"].count()) == (6, 12)
    assert read_silver(spark, result.folder)["asistencia"].count() == 24
    plan = later["notas"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(periodo" in plan and "PushedFilters: []" in plan
    for table in PERFORMANCE.all_tables():
        part = rebuild(spark, result.folder, PERFORMANCE, table.name, "2027/I = x")
        whole = spark.read.parquet(f"{result.folder}/gold/{table.name}.parquet")
        mark = "curso_id" if "curso_id" in whole.columns else "estudiante_id"
        assert part.collect() == table.ordered(whole.filter(f"{mark} like '%b'")).collect(), table.name


def test_facts_without_valid_rows_can_be_read(spark, tmp_path):
    batch = worked_example()
    batch["notas"] = [row[:2] + ["P0"] + row[3:] for row in batch["notas"]]
    result = run_batch(spark, write_csv(batch, tmp_path / "in"), str(tmp_path / "out"), PERFORMANCE, 1.0)
    assert read_silver(spark, result.folder)["notas"].count() == 0
    assert rebuild(spark, result.folder, PERFORMANCE, "rendimiento", "2026-II").count() == 3
