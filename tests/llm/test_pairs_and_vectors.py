"""Near duplicates, exact top-k, nearest neighbours and mixing against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest

from gradeflow.llm import exact_topk, mixing, near_dedup, neighbours
from gradeflow.llm.shingles import shingle_set

DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, class string, key int, n int"


def documents(spark, rows):
    """(doc_id, text, source) with further columns whose names the operators use inside."""
    full = [(i, t, "en", s, 0, "h", "c", 1, 2) for i, t, s in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def brute_components(rows, width=4, percent=80):
    sets = []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        step = min(width, len(words))
        sets.append({tuple(words[i : i + step]) for i in range(len(words) - step + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    least = {}
    for at, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(at)] = min(doc_id, least.get(root(at), doc_id))
    return [(i, len(sets[at]), least.get(root(at))) for at, (i, _) in enumerate(rows)]


def near_copies(seed):
    """Groups of texts around the threshold, chains, shared passages and odd cases."""
    chance = random.Random(seed)
    word = lambda: "".join(chance.choices("abcdefgh", k=5))
    passage = [word() for _ in range(25)]
    texts = []
    for _ in range(12):
        base = [word() for _ in range(chance.randint(30, 120))]
        if chance.random() < 0.4:
            base[10:10] = passage
        for _ in range(chance.randint(1, 9)):
            copy = list(base)
            for _ in range(chance.randint(0, 4)):
                copy[chance.randrange(len(copy))] = word()
            texts.append(" ".join(copy))
            if chance.random() < 0.3:
                base = copy
    texts += ["one two", "One  TWO\n", "one", "", " \t\n", None, "x " * 5000, "É é É é", "é é é é", texts[0], texts[0].upper()]
    chance.shuffle(texts)
    return list(enumerate(texts, 1))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates_equal_brute_force(spark, seed):
    rows = near_copies(seed)
    got = near_dedup.near_duplicates(documents(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_a_large_group_of_near_copies_is_settled_in_blocks(spark, monkeypatch):
    """Copies that share edits, so that no shingle is alone and the bound drops none."""
    chance = random.Random(5)
    base = [f"w{i}" for i in range(60)]
    edits = [(chance.randrange(60), f"e{i}") for i in range(6)]
    rows = []
    for i in range(1, 150):
        copy = list(base)
        for at, word in chance.sample(edits, chance.randint(0, 5)):
            copy[at] = word
        rows.append((i, " ".join(copy)))
    monkeypatch.setattr(near_dedup, "BLOCK_CLASSES", 16)
    got = near_dedup.near_duplicates(documents(spark, [(i, t, None) for i, t in rows])).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(brute_components(rows))


def test_near_duplicates_of_repeated_and_null_ids(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(7, a), (7, a), (7, b), (None, a), (9, b), (None, "c d e f"), (None, None), (3, ""), (3, "")]
    docs = documents(spark, [(i, t, "s") for i, t in rows])
    got = near_dedup.near_duplicates(docs).collect()
    found = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in got)
    assert found == sorted(
        [("7", 27, "7", True)] * 3
        + [("None", 27, "7", False), ("9", 27, "7", False), ("None", 1, "None", False), ("None", 0, "None", False)]
        + [("3", 0, "3", True)] * 2
    )
    kept = near_dedup.one_of_each(docs).collect()
    assert sorted((str(r.doc_id), str(r.text)) for r in kept) == sorted(
        [("7", a), ("7", b), ("None", "c d e f"), ("None", "None"), ("3", "")]
    )


def test_one_of_each_keeps_texts_out_of_python_workers(spark):
    """Kept rows are found by id and digest: they don't cross Python, which holds whole batches of texts."""
    a = " ".join(f"a{i}" for i in range(30))
    docs = documents(spark, [(1, a, "s"), (1, a.upper(), "s"), (2, a, "s"), (2, "x", "s"), (None, None, "s")])
    kept = near_dedup.one_of_each(docs)
    assert "InArrow" not in kept._jdf.queryExecution().toString()
    found = sorted((str(r.doc_id), str(r.text).lower()) for r in kept.collect())
    assert found == [("1", a), ("2", "x"), ("None", "none")]


def test_near_duplicates_of_nothing(spark):
    assert near_dedup.near_duplicates(documents(spark, [])).collect() == []
    assert near_dedup.one_of_each(documents(spark, [])).collect() == []


def test_signatures_differ_about_as_sets_do():
    chance = random.Random(2)
    differ = []
    for _ in range(300):
        words = [str(chance.random()) for _ in range(400)]
        one, two = shingle_set(" ".join(words), 1), shingle_set(" ".join(words[44:] + [str(chance.random()) for _ in range(44)]), 1)
        differ.append((near_dedup.signature(one) != near_dedup.signature(two)).mean())
    # 356 of 444 in common.
    assert abs(np.mean(differ) - 88 / 444) < 0.01


VECTORS = "vec_id long, embedding array<float>, label int, vec string, bin int, part int, score double"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, e, 0, "v", 1, 2, 3.0) for i, e in rows], VECTORS).repartition(4)


def odd_vectors(chance, count, width):
    rows = [(i, [round(float(x), 2) for x in chance.normal(size=width)]) for i in range(count)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2050, [1.0, None] + [0.0] * (width - 2)), (2100, [float("nan")] * width)]
    rows += [(2150, [float("inf")] + [0.0] * (width - 1)), (None, [1.0] * width), rows[5], rows[5]]
    return rows


def usable(rows):
    return [(i, np.array(np.array(e, np.float32), float)) for i, e in rows if i is not None and e and None not in e and np.isfinite(e).all()]


@pytest.mark.parametrize("block", [7, 2048])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(exact_topk, "BLOCK", block)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 3)
    rows = odd_vectors(np.random.default_rng(1), 130, 6)
    got = exact_topk.top_k(embeddings(spark, rows)).collect()
    good = [(i, np.floor(256 * e).astype(int)) for i, e in usable(rows)]
    wanted = []
    for query in sorted({i for i, _ in good if i % 50 == 0}):
        vector = next(e for i, e in good if i == query)
        best = sorted((-int(vector @ e), i) for i, e in good if i != query)[:5]
        wanted += [(query, rank, i, -s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == wanted


def test_no_block_is_copied_for_another(spark, monkeypatch):
    """Queries are sent as often as ``SENT_BYTES`` needs; candidates stay in place, one row a block."""
    monkeypatch.setattr(exact_topk, "BLOCK", 16)
    monkeypatch.setattr(exact_topk, "QUERY_BLOCK", 2)
    plans, land = [], exact_topk.landed

    def remember(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return land(df)

    monkeypatch.setattr(exact_topk, "landed", remember)
    chance = np.random.default_rng(2)
    vectors = embeddings(spark, [(i, chance.normal(size=4).tolist()) for i in range(0, 2000, 10)])
    once = exact_topk.top_k(vectors).collect()
    grids = [plan for plan in plans if "MapInArrow" in plan]
    assert len(grids) == len(exact_topk.SHIFTS) + 1
    assert all("Generate explode" not in plan and "Join Cross, rightHint=(strategy=broadcast)" in plan for plan in grids)
    # 40 queries of 160 bytes take several turns.
    monkeypatch.setattr(exact_topk, "SENT_BYTES", 1500)
    plans.clear()
    assert sorted(exact_topk.top_k(vectors).collect()) == sorted(once) and len(once) == 200
    assert len([plan for plan in plans if "MapInArrow" in plan]) == 5 * len(grids)


def test_top_k_of_few_none_long_and_large(spark):
    assert exact_topk.top_k(embeddings(spark, [])).collect() == []
    assert exact_topk.top_k(embeddings(spark, [(50, [1.0, 2.0])])).collect() == []
    got = exact_topk.top_k(embeddings(spark, [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, [-1e6, 0.0, 5.0])])).collect()
    assert [(r.query_id, r["rank"], r.vec_id, r.score) for r in sorted(got)] == [
        (0, 1, 1, 65536),
        (0, 2, 2, 0),
        (0, 3, 3, -65536000000),
    ]


def test_nearest_neighbours_recall_and_scores(spark):
    chance = np.random.default_rng(3)
    centres = chance.normal(size=(30, 16)) * 2
    rows = [(i, [float(np.float32(x)) for x in centres[i % 30] + chance.normal(size=16)]) for i in range(2000)]
    rows += [(3000 + i, rows[100][1]) for i in range(300)]
    got = neighbours.nearest(embeddings(spark, rows), sample=1500).collect()
    ids, table = np.array([i for i, _ in rows]), np.array([e for _, e in rows])
    hits = 0
    for query in [i for i in ids if i % 100 == 0]:
        mine = sorted((r for r in got if r.query_id == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        far = np.sqrt(((table - table[ids == query][0]) ** 2).sum(axis=1))
        assert all(r.score == far[ids == r.vec_id][0] for r in mine)
        assert [(r.score, r.vec_id) for r in mine] == sorted((r.score, r.vec_id) for r in mine)
        far[ids == query] = np.inf
        hits += len({r.vec_id for r in mine} & set(ids[np.lexsort((ids, far))[:10]]))
    assert hits >= 0.9 * 10 * sum(i % 100 == 0 for i in ids)


def test_nearest_neighbours_of_odd_rows(spark):
    assert neighbours.nearest(embeddings(spark, [])).collect() == []
    rows = [*odd_vectors(np.random.default_rng(1), 20, 4), (100, [0.0] * 4), (200, [0.0, 1.0]), (201, [])]
    got = neighbours.nearest(embeddings(spark, rows)).collect()
    good = [(i, np.pad(e, (0, 4 - len(e)))) for i, e in usable(rows) if e.any()]
    wanted = []
    for query in sorted({i for i, _ in good if i % 100 == 0}):
        vector = next(e for i, e in good if i == query)
        best = sorted((math.sqrt(((e - vector) ** 2).sum()), i) for i, e in good if i != query)[:10]
        wanted += [(query, rank, i, s) for rank, (s, i) in enumerate(best, 1)]
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == wanted


def test_few_parts_are_visited_of_clustered_vectors(spark):
    """Parts grow with the table, and most are left out without losing neighbours."""
    chance = np.random.default_rng(4)
    centres = chance.normal(size=(64, 16)) * 4
    table = centres[np.arange(3000) % 64] + chance.normal(size=(3000, 16))
    rows = embeddings(spark, [(i, [float(x) for x in e]) for i, e in enumerate(table)])
    got = neighbours.nearest(rows, parts=32).collect()
    hits = 0
    for query in range(0, 3000, 100):
        far = ((table - table[query]) ** 2).sum(axis=1)
        far[query] = np.inf
        hits += len({r.vec_id for r in got if r.query_id == query} & set(np.argsort(far)[:10]))
    assert hits >= 0.95 * 300 and len(got) == 300
    usable_rows = neighbours.usable(rows, "vec_id", "embedding", zero=False)
    routes = neighbours.fitted(usable_rows, 4096, 32, 10, 0.95)
    assert routes.parts == 32 and 2 * routes.probes < routes.parts
    index = {r.part: r["count"] for r in neighbours.routed(usable_rows, routes).groupBy("part").count().collect()}
    asked = neighbours.routed(
        usable_rows.filter("vec_id % 100 = 0").selectExpr("*", "1 as own"), routes, [index.get(p, 0) for p in range(32)], 10
    )
    assert 2 * sum(index.get(r.part, 0) for r in asked.collect()) < 30 * 3000


def test_more_parts_are_visited_where_few_vectors_lie(spark):
    """A query among three others, two of them under its own id, still gets all ten."""
    chance = np.random.default_rng(5)
    rows = [(i, [float(x) for x in chance.normal(size=4)]) for i in range(1, 900) if i % 100]
    rows += [(100, [500.0, 500.0, 500.0, 500.0])] * 3 + [(950 + i, [501.0, 500.0, 500.0, 500.0 + i]) for i in range(3)]
    got = neighbours.nearest(embeddings(spark, rows), sample=600, recall=0.01).collect()
    assert [r["rank"] for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 11))
    assert {r.vec_id for r in got if r["rank"] <= 3} == {950, 951, 952}
    few = [*rows[:5], (100, [1.0] * 4)]
    assert len(neighbours.nearest(embeddings(spark, few)).collect()) == 5


def test_nearest_neighbours_of_huge_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 3e199]), (2, [-1e200, 0.0]), (3, [1.0, 1.0]), (4, [1.7e308, 0.0])]
    got = neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == [1, 3, 2, 4]
    scores = {r.vec_id: r.score for r in got}
    assert scores[1] == pytest.approx(3e199) and scores[2] == pytest.approx(2e200) and scores[4] == pytest.approx(1.7e308)


def brute_mix(rows):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {n: sum(size(t) for _, t, s in rows if s == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, rest, free = dict.fromkeys(names, 0.0), 1.5 * sum(total.values()), set(names)
    while rest > 1e-9 and free:
        share = rest / sum(weight[n] for n in free)
        for n in free:
            target[n] += share * weight[n]
        rest = sum(max(0, target[n] - 2 * total[n]) for n in free)
        free = {n for n in free if target[n] < 2 * total[n]}
        target = {n: min(target[n], 2 * total[n]) for n in names}
    return total, target


def test_mixing_reaches_the_targets(spark):
    chance = random.Random(4)
    rows = [(i, "w " * chance.randint(0, 40), chance.choice(["b", "a", "é", "Z", None, "hot", "hot", "hot"])) for i in range(900)]
    rows += [(901, None, "a"), (902, "x " * 9000, "long"), (903, "", "empty"), (None, "y z", "b"), rows[0], rows[0]]
    docs = documents(spark, rows)
    got = mixing.mix(docs).collect()
    total, target = brute_mix(rows)
    assert len(got) == len(rows)
    for name in total:
        mine = [(i, t) for i, t, s in rows if s == name]
        ids = {i for i, _ in mine}
        own = [r for r in got if r.doc_id in ids]
        assert {r.source_size for r in own} == {total[name]}
        assert all(abs(r.target - target[name]) < 1e-6 for r in own)
        assert abs(sum(r.taken for r in own) - target[name]) <= max([r.size for r in own], default=0) * 3
    assert all(r.taken <= 2 * r.size and r.taken == r.size * r.repeats for r in got)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    applied = mixing.apply_mix(docs)
    assert applied.columns == docs.columns
    assert applied.count() == sum(r.repeats for r in got)


def test_mixing_equals_sql_and_is_nested(spark):
    chance = random.Random(8)
    rows = [(i, "w " * chance.randint(0, 9), chance.choice("abcd")) for i in range(300)]
    docs = documents(spark, rows)
    con = duckdb.connect()
    frame = docs.toPandas()  # noqa: F841
    con.execute("create table documents as select * from frame")
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    wanted = con.execute(f"select {', '.join(columns)} from ({mixing.MIX_SQL})").fetchall()
    got = [tuple(r) for r in mixing.mix(docs).select(*columns).collect()]
    assert sorted(got) == sorted(wanted)
    less = {r.doc_id for r in mixing.mix(docs, share=0.2, weights=(1,)).collect() if r.repeats}
    more = {r.doc_id for r in mixing.mix(docs, share=0.4, weights=(1,)).collect() if r.repeats}
    assert less and less < more


def test_mixing_of_nothing(spark):
    assert mixing.mix(documents(spark, [])).collect() == []
    assert [r.taken for r in mixing.mix(documents(spark, [(1, None, "a"), (2, "", None)])).collect()] == [0, 0]
    assert mixing.apply_mix(documents(spark, [])).collect() == []


def test_hashes_are_those_of_the_ids():
    assert int(hashlib.md5(b"7").hexdigest()[:15], 16) < 1 << mixing.HASH_BITS
