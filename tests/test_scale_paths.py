"""The operators for large tables against brute force, on skewed data."""

from __future__ import annotations

import json
import random

import pytest
from batches import frames, published, worked_example
from pyspark.sql import functions as F

from gradeflow.contract import CONTRACTS
from gradeflow.operators.duplicates import (
    BLOCK_BYTES,
    blocks_bound,
    blocks_tell,
    mark_by_blocks,
    mark_duplicates,
    repeated_bound,
    repeated_keys,
    staying_rows,
)
from gradeflow.operators.enrol import enrol, large_terms
from gradeflow.operators.lookup import Limits, Size, attach, hot_keys, hot_threshold
from gradeflow.operators.merit import add_merit
from gradeflow.plans import validation
from gradeflow.sinks.publish import publish_counted
from gradeflow.sources.workspace import measure

TIGHT = Limits(broadcast_bytes=-1)


def skewed_notas(rows: int, seed: int):
    """Flagged rows of which a third copies one key and a tenth has no full key."""
    rng = random.Random(seed)
    out = []
    for fila in range(2, rows + 2):
        if rng.random() < 0.33:
            key = ["E1", "C1", "P1", "EP"]
        else:
            key = [f"E{rng.randrange(40)}", f"C{rng.randrange(4)}", "P1", rng.choice(["EP", "EF"])]
        if rng.random() < 0.1:
            key[rng.randrange(4)] = None
        motivos = rng.choice(["", "", "PESO_INVALIDO"])
        out.append((*key, "0.5", "12", None, fila, motivos))
    return out


def expected_reasons(rows):
    """The rule applied row by row in plain Python."""
    first = {}
    for row in rows:
        key, rank = row[:4], (row[8] != "", row[7])
        if None not in key and (key not in first or rank < first[key]):
            first[key] = rank
    out = {}
    for row in rows:
        codes = [row[8]] if row[8] else []
        if None not in row[:4] and first[row[:4]][1] != row[7]:
            codes.append("REGISTRO_DUPLICADO")
        out[row[7]] = "|".join(codes)
    return out


NOTAS_SCHEMA = ", ".join(f"{c} string" for c in CONTRACTS["notas"].columns)
FLAGGED_SCHEMA = NOTAS_SCHEMA + ", fila long, motivos string"


@pytest.mark.parametrize("seed", [1, 2])
def test_duplicates_match_brute_force(spark, seed):
    rows = skewed_notas(3000, seed)
    flagged = spark.createDataFrame(rows, FLAGGED_SCHEMA)
    table = CONTRACTS["notas"]
    expected = expected_reasons(rows)
    repeated = repeated_keys(flagged, table)
    variants = {
        "shuffled": mark_duplicates(flagged, table, len(rows), limits=TIGHT),
        "broadcast": mark_duplicates(flagged, table, len(rows), repeated, measure(repeated)),
    }
    for name, df in variants.items():
        assert {r["fila"]: r["motivos"] for r in df.collect()} == expected, name
    assert "Window" not in variants["shuffled"]._jdf.queryExecution().toString()


def test_hot_and_missing_keys_do_not_meet_in_one_task(spark):
    """A third of the rows on one key and a third without: every task gets a share."""
    rows = [(fila, "E1" if fila % 3 == 0 else None if fila % 3 == 1 else f"E{fila}") for fila in range(9000)]
    facts = spark.createDataFrame(rows, "fila long, estudiante_id string")
    students = spark.createDataFrame(
        [(f"E{n}", f"S{n % 5}") for n in range(9000)], "estudiante_id string, semestre_id string"
    )
    hot = hot_keys(facts, ["estudiante_id"], len(rows))
    assert [r[0] for r in hot.collect()] == ["E1"]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        looked = attach(
            facts, students, ["estudiante_id"], "estudiante", size=Size(9000, 10**12), hot=hot
        )
        per_task = looked.groupBy(F.spark_partition_id()).count().collect()
        found = {r["fila"]: r["estudiante"] for r in looked.collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(per_task) == 8
    assert max(r["count"] for r in per_task) < 2 * len(rows) / 8
    for fila, student in rows:
        if student is None:
            assert found[fila] is None
        else:
            assert found[fila]["semestre_id"] == f"S{int(student[1:]) % 5}"


def test_hot_keys_are_few_by_construction():
    for rows in (10, 10_000, 10**12):
        assert rows / hot_threshold(rows) <= 2000


def test_broadcast_only_within_the_limit(spark):
    facts = spark.range(10).selectExpr("id as fila", "cast(id as string) as k")
    reference = spark.range(5).selectExpr("cast(id as string) as k", "id as v")
    size = measure(reference)
    assert size.rows == 5 and size.bytes >= size.widest >= 1
    small = attach(facts, reference, ["k"], "r", size=size, limits=Limits(broadcast_bytes=size.bytes))
    over = attach(facts, reference, ["k"], "r", size=size, limits=Limits(broadcast_bytes=size.bytes - 1))
    hint = "strategy=broadcast"
    assert hint in small._jdf.queryExecution().toString()
    assert hint not in over._jdf.queryExecution().toString()
    assert sorted(map(repr, small.collect())) == sorted(map(repr, over.collect()))


def test_enrolments_of_a_large_catalogue(spark):
    students = spark.range(500).selectExpr("concat('E', id) as e", "if(id % 3 = 0, 'S0', concat('S', id % 7)) as s")
    catalogue = spark.range(30).selectExpr("concat('C', id) as c", "concat('S', id % 7) as s")
    small = enrol(students, catalogue, "s", "e", Size(30, 100))
    large = enrol(students, catalogue, "s", "e", Size(30, 10**12))
    assert small.columns == large.columns
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))


def test_large_terms_alone_are_dealt_into_parts(spark):
    students = spark.range(900).selectExpr("concat('E', id) as e", "if(id % 3 = 0, 'S0', concat('S', id % 90)) as s")
    catalogue = spark.range(200).selectExpr("concat('C', id) as c", "concat('S', id % 100) as s")
    small = enrol(students, catalogue, "s", "e", Size(30, 100))
    large = enrol(students, catalogue, "s", "e", Size(30, 10**12), part=50)
    assert small.columns == large.columns
    assert sorted(map(repr, small.collect())) == sorted(map(repr, large.collect()))
    assert [tuple(r) for r in large_terms(students, "s", 50).collect()] == [("S0", 6)]


@pytest.mark.parametrize("groups", [Size(3, 300, 100), Size(3, 10**12, 10**12), None])
def test_merit_order_matches_brute_force(spark, groups):
    rng = random.Random(3)
    rows = []
    for n in range(900):
        term = "V" if rng.random() < 0.6 else rng.choice(["I", "II"])
        average = None if rng.random() < 0.1 else rng.randrange(900, 1300) / 100
        rows.append((f"E{n}", term, "P1", average))
    totals = spark.createDataFrame(rows, "e string, s string, p string, promedio double")
    limits = Limits() if groups and groups.bytes < 1000 else TIGHT
    large = add_merit(totals, ["s", "p"], "promedio", "e", 900, groups, limits)
    small = add_merit(totals, ["s", "p"], "promedio", "e", 900, groups)
    assert small.dtypes == large.dtypes
    expected = {}
    for student, term, _, average in rows:
        peers = [r[3] for r in rows if r[1] == term]
        known = [a for a in peers if a is not None]
        ahead = len(known) if average is None else sum(a > average for a in known)
        expected[student] = (ahead + 1, ahead + 1 <= -(-len(peers) // 3))
    for df in (small, large):
        assert {r["e"]: (r["orden_merito"], r["tercio_superior"]) for r in df.collect()} == expected


def test_hot_repeated_keys_are_found_without_a_join(spark):
    flagged = spark.createDataFrame(skewed_notas(200, 3), FLAGGED_SCHEMA)
    table = CONTRACTS["notas"]
    marked = mark_duplicates(flagged, table, 200, repeated_keys(flagged, table), Size(9, 10**12), TIGHT)
    assert "LeftSemi" not in marked._jdf.queryExecution().toString()


def test_students_are_measured_by_the_columns_that_are_looked_up(spark, monkeypatch):
    """Whole students are beyond the limit, what facts look up of them is within it: no hot keys are sought."""
    batch = frames(spark, worked_example())
    whole, slim = measure(batch["estudiantes"]), measure(batch["estudiantes"].select(*validation.STUDENT_REFERENCE))
    expected = validation.validate(batch)

    def unwanted(*args):
        raise AssertionError("the reference fits")

    monkeypatch.setattr(validation, "hot_keys", unwanted)
    limits = Limits(broadcast_bytes=max(slim.bytes, measure(batch["cursos"]).bytes + measure(batch["semestres"]).bytes))
    assert limits.broadcast_bytes < whole.bytes
    found = validation.validate(batch, limits=limits)
    for name in CONTRACTS:
        assert sorted(map(repr, found.checked[name].collect())) == sorted(map(repr, expected.checked[name].collect()))
    assert found.sizes == expected.sizes


def test_facts_of_a_large_reference_are_derived_once(spark):
    batch = frames(spark, worked_example())
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for part in batches:
            seen.add(part.num_rows)
            yield part

    rows = batch["notas"].count()
    batch["notas"] = batch["notas"].mapInArrow(counted, batch["notas"].schema)
    found = validation.validate(batch, limits=TIGHT)
    assert found.sizes["notas"] == Size(rows, None) and found.silver["notas"].count() == rows
    assert seen.value == rows


@pytest.mark.parametrize("shift", [0, 32_766, -70_000])
def test_duplicates_by_blocks_match_brute_force(spark, shift):
    """Bits over several blocks, and row numbers around the borders of blocks."""
    table = CONTRACTS["notas"]
    rows = [(*r[:7], (r[7] - 2) * 31 + shift, r[8]) for r in skewed_notas(3000, 4)]
    flagged = spark.createDataFrame(rows, FLAGGED_SCHEMA)
    blocks = staying_rows(flagged, table).localCheckpoint()
    assert 1 < blocks.count() <= blocks_bound(flagged).rows
    assert blocks_tell(flagged, table, blocks)
    marked = mark_by_blocks(flagged, table, blocks)
    assert marked.columns == flagged.columns
    assert {r["fila"]: r["motivos"] for r in marked.collect()} == expected_reasons(rows)


def test_blocks_tell_when_row_numbers_repeat(spark):
    table = CONTRACTS["notas"]
    row = (None, None, None)
    cases = {
        # Row 3 is a copy of key A and the first row of key B.
        "shared": [("A", "C", "P", "E", *row, 2, ""), ("A", "C", "P", "E", *row, 3, ""), ("B", "C", "P", "E", *row, 3, "")],
        # Two rows of one number and key: both stay.
        "tied": [("A", "C", "P", "E", *row, 2, ""), ("A", "C", "P", "E", *row, 2, "")],
        "right": [("A", "C", "P", "E", *row, 2, ""), (None, "C", "P", "E", *row, 2, ""), ("B", "C", "P", "E", *row, None, "")],
    }
    for name, rows in cases.items():
        flagged = spark.createDataFrame(rows, FLAGGED_SCHEMA)
        assert blocks_tell(flagged, table, staying_rows(flagged, table)) == (name == "right"), name


@pytest.mark.parametrize("double", [False, True])
def test_many_repeated_keys_are_marked_without_shuffling_the_rows(spark, double):
    """Between the limits rows find their bit by a broadcast; repeated numbers take the join, with the same result."""
    batch = frames(spark, worked_example() | {"notas": [list(r[:7]) for r in skewed_notas(600, 5)]})
    if double:
        batch["notas"] = batch["notas"].unionByName(batch["notas"].limit(100))
    expected = validation.validate(batch).checked["notas"]
    limits = Limits(broadcast_bytes=3 * BLOCK_BYTES)
    assert not limits.broadcasts(repeated_bound(CONTRACTS["notas"], 600))
    found = validation.validate(batch, limits=limits).checked["notas"]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    plan = found._jdf.queryExecution().toString()
    assert ("palabras" in plan) != double
    assert double or ("SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan)


def test_rejected_rows_are_sorted_without_the_texts_made_of_them(spark):
    """Key and record are made above the sort; they say the same for every table."""
    batch = frames(spark, worked_example() | {"estudiantes": [["E9", None, "x", "y", "S", None]]})
    result = validation.validate(batch)
    lines = result.quarantine()._jdf.queryExecution().optimizedPlan().toString().splitlines()
    sort = next(place for place, line in enumerate(lines) if "Sort [" in line)
    assert any("AS registro#" in line for line in lines[:sort])
    assert not any("AS registro#" in line or "AS clave#" in line for line in lines[sort:])
    for name, table in CONTRACTS.items():
        rows = {r["fila"]: r for r in batch[name].collect()}
        found = result.quarantine().filter(F.col("tabla") == name).collect()
        assert len(found) == result.checked[name].filter("motivos <> ''").count()
        for r in found:
            cells = rows[r["fila"]].asDict()
            assert json.loads(r["registro"]) == {c: cells[c] for c in table.columns}
            assert list(json.loads(r["registro"])) == list(table.columns)
            assert r["clave"] == " · ".join("?" if cells[c] is None else cells[c] for c in table.key)


def test_what_finishes_published_rows_is_not_shuffled(spark, tmp_path):
    df = spark.range(50).selectExpr("cast(id as int) as id").repartition(4)
    wide = lambda rows: rows.selectExpr("id", "repeat('x', id) as t")
    written, rows = publish_counted(df, str(tmp_path), "t", [F.col("id").desc()], finish=wide)
    assert rows == 50 and written.columns == ["id", "t"]
    assert {(r["id"], r["t"]) for r in written.collect()} == {(n, "x" * n) for n in range(50)}
    back = published(spark, str(tmp_path), "t")
    assert [(r["id"], r["t"] or "") for r in back] == [(str(n), "x" * n) for n in range(49, -1, -1)]
