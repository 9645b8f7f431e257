"""Benchmark passages, the prefix trie and centroid clustering against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from gradeflow.llm import centroids, decontamination, prefix_trie
from gradeflow.llm.common import STEPS, steps_of


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Benchmark passages ---------------------------------------------------------------------


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def brute_contamination(docs, items, width=10):
    windows = []
    for item, text in items:
        w = plain_words(text)
        n = min(width, len(w))
        windows += [("" if item is None else str(item), w[i : i + n]) for i in range(len(w) - n + 1) if n]
    out = []
    for doc_id, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for item, v in windows:
            for s in range(len(w) - len(v) + 1):
                if w[s : s + len(v)] == v:
                    hit.update(range(s, s + len(v)))
                    found.add(item)
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def passages_fixture(seed):
    chance = random.Random(seed)
    some = ["la", "le", "Été", "été", "x1", "Zwei", "zwei", "o", "日本", "rare%d"]
    word = lambda: chance.choice(some).replace("%d", str(chance.randint(0, 40)))
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate([30, 12, 10, 9, 3, 1, 0, 11, 25])]
    items += [(9, None), (10, items[0][1].upper()), (2, items[1][1]), (None, items[7][1]), (100, " ".join(["la"] * 14))]
    docs = [(None, None), (1, ""), (2, " .,\n"), (2, "la " * 500), (3, "rare1")]
    for i in range(4, 40):
        text = [word() for _ in range(chance.randint(0, 60))]
        for _ in range(chance.randint(0, 3)):
            w = (chance.choice(items)[1] or "").split()
            a = chance.randint(0, max(0, len(w) - 8))
            at = chance.randint(0, len(text))
            text[at:at] = w[a : a + chance.randint(5, 25)]
        docs.append((i, chance.choice([" ", ", ", "\n-"]).join(text)))
    return docs + docs[-5:], items


def tables(spark, docs, items):
    d = spark.createDataFrame([(*r, 1, "x", [2]) for r in docs], "doc_id long, text string, row int, term string, spans array<int>")
    i = spark.createDataFrame([(*r, "y", 3) for r in items], "item_id long, text string, words string, passage int")
    return d.repartition(3), i.repartition(2)


@pytest.mark.parametrize(("seed", "sent"), [(1, 1 << 21), (2, 1 << 21), (2, 0)])
def test_contamination_equals_brute_force(spark, seed, sent, monkeypatch):
    monkeypatch.setattr(decontamination, "SENT", sent)
    docs, items = passages_fixture(seed)
    got = decontamination.contamination(*tables(spark, docs, items)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_contamination(docs, items), key=key)


def test_contamination_of_empty_tables(spark):
    docs, items = passages_fixture(1)
    d, i = tables(spark, docs, items)
    assert decontamination.contamination(d.limit(0), i).count() == 0
    got = decontamination.contamination(d, i.limit(0)).collect()
    assert len(got) == len(docs) and not any(r.contaminated for r in got)
    assert {r.items_sha256 for r in got} == {sha("")}


def test_spans_name_the_place_of_each_match(spark):
    docs, items = passages_fixture(2)
    d, i = tables(spark, docs, items)
    found, _ = decontamination.passages(i)
    checked = decontamination.phrase_matches(decontamination.index(d), found)
    words = {r.passage: r.words for r in found.collect()}
    texts = dict(docs)
    spans = [(r.doc_id, s) for r in checked.collect() for s in r.spans or []]
    assert len(spans) > 100
    assert all(len(words[s.passage]) == s.stop - s.start for _, s in spans)
    assert all(plain_words(texts[i])[s.start : s.stop] in words.values() for i, s in spans)


@pytest.mark.parametrize("near", [4, 12])
def test_proximity_equals_brute_force(spark, near):
    docs, _ = passages_fixture(3)
    items = [(1, "le rare1"), (2, "zwei la le"), (3, "rare3 rare2 la"), (4, "rare5"), (5, "zwei zwei"), (6, "la nowhere")]
    d, i = tables(spark, docs, items)
    found, holders = decontamination.passages(i, None)
    matches = decontamination.proximity_matches(decontamination.index(d), found, near)
    got = matches.join(holders, "passage").select("row", "doc_id", "item", "start").distinct().collect()
    want = []
    for doc_id, text in docs:
        w = plain_words(text)
        for item, t in items:
            need = set(plain_words(t))
            starts = [s for s in range(max(1, len(w) - near + 1)) if need <= set(w[s : s + near])]
            if starts:
                want.append((-1 if doc_id is None else doc_id, str(item), starts[0]))
    assert want and sorted((-1 if r.doc_id is None else r.doc_id, r["item"], r.start) for r in got) == sorted(want)


def test_contamination_runs_without_python(spark):
    docs, items = passages_fixture(1)
    plan = decontamination.contamination(*tables(spark, docs, items))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


# Prefix trie ----------------------------------------------------------------------------


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            own.setdefault(conv, []).append(((turn is not None, turn or 0, mark), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        family = c - int(np.fmod(c, 100))
        out[c] = own.get(family, [])[:h] + own[c][h:]
    return out


def brute_trie(rows):
    convs = rebuilt(rows)
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, m in members.items():
        own = (len(m) - 1) * len(node[-1][1]) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += own
    out = []
    for node, m in members.items():
        ends = sorted(c for c in m if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        told = (len(m), len(children.get(node, ())), leaves[node], saved[node], sha(",".join(map(str, ends))))
        out.append((min(m), len(node), parent, *told))
    return out


def conversations(spark, rows):
    shape = "conv_id long, turn long, role string, text string, family string, path int, size string, node int"
    return spark.createDataFrame([(*r, "f", 1, "s", 2) for r in rows], shape).repartition(3)


def talks(seed):
    chance = random.Random(seed)
    rows = []
    for c in [*range(-3, 60), *range(100, 130), 205, 999]:
        for t in range(chance.randint(1, 9)):
            rows.append((c, chance.choice([t, t, t, None]), chance.choice(["user", "bot", None, ""]), chance.choice(["a", "bé", "ccc", None, "日本語"])))
    # Copies of one conversation, longer than any splitter's sample and cut between shards.
    for c in range(1000, 1150):
        rows += [(c, t, "user", f"copy {t}") for t in range(6, 12)]
    rows += [(7, 3, "user", "a")] * 3 + [(None, 1, "user", "lost")]
    rows += [(5000, t, "user", f"deep {t}") for t in range(300)]
    return rows


@pytest.mark.parametrize(("seed", "shard"), [(1, 7), (1, 1024), (2, 20)])
def test_trie_equals_brute_force(spark, seed, shard, monkeypatch):
    monkeypatch.setattr(prefix_trie, "ENDS", 8)
    rows = talks(seed)
    got = sorted(map(tuple, prefix_trie.trie(conversations(spark, rows), shard).collect()), key=repr)
    assert got == sorted(brute_trie(rows), key=repr)


def test_trie_of_no_conversations(spark):
    assert prefix_trie.trie(conversations(spark, talks(1)[:1]).limit(0)).count() == 0
    assert prefix_trie.trie(conversations(spark, [(None, 1, "user", "a")])).count() == 0


def test_a_conversation_without_turns_is_a_member_of_the_root(spark):
    # 4 turns of its own, all replaced by those of a first conversation that is not there.
    short = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 == 5)
    got = prefix_trie.trie(conversations(spark, [(short, t, "user", "a") for t in range(4)])).collect()
    assert [tuple(r) for r in got] == [(short, 0, None, 1, 0, 1, 0, sha(str(short)))]


def test_splitters_cut_copies_of_one_conversation(spark):
    rows = prefix_trie.landed(prefix_trie.paths(conversations(spark, talks(1))))
    cuts = prefix_trie.splitters(rows, 7)
    assert cuts == sorted(cuts) and len({path for path, _ in cuts}) < len(cuts)
    sizes = prefix_trie._sharded(rows, cuts).groupBy("shard").count().collect()
    assert max(r["count"] for r in sizes) <= 40


def test_a_share_of_a_large_table_is_never_empty():
    assert steps_of(4000 / 1e12) / STEPS == pytest.approx(4e-9, rel=1e-6)
    assert steps_of(0.0) == 0 and steps_of(1.0) == STEPS and steps_of(2.0) == STEPS


# Centroids ------------------------------------------------------------------------------


def brute_clusters(vectors, count=16, rounds=3):
    kept = []
    for i, v in vectors:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(64 * np.float64(x))) for x in v]))
    order = sorted(kept, key=lambda r: (sha("1:" + ("" if r[0] is None else str(r[0]))), r[1]))
    centers = [list(x) for _, x in order[:count]]

    def nearest(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), j) for j, c in enumerate(centers))

    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x)[1], []).append(x)
        for j, xs in groups.items():
            centers[j] = [sum(column) // len(xs) for column in zip(*xs)]
    found = [(i, *nearest(x)) for i, x in kept]
    of = {}
    for _, d, j in found:
        of[j] = of.get(j, 0) + d
    return [(i, j, d, of[j], sum(of.values()), sha(",".join(map(str, centers[j])))) for i, d, j in found]


def vectors(spark, rows):
    shape = "vec_id long, embedding array<float>, label int, x string, cluster string, distance int"
    return spark.createDataFrame([(i, v, 0, "x", "c", 1) for i, v in rows], shape).repartition(3)


def cloud(seed, size=300):
    rng = np.random.default_rng(seed)
    middles = rng.normal(size=(9, 64))
    rows = [(int(i), (middles[i % 9] + rng.normal(size=64) * 0.4).astype(np.float32).tolist()) for i in range(size)]
    rows += [(1000 + i, [0.0] * 64) for i in range(40)] + [(1, rows[1][1]), (None, rows[2][1]), (None, [1.0] * 64)]
    rows += [(2000, None), (2001, []), (2002, [1.0] * 63), (2003, [1.0] * 65), (2004, [None] + [0.0] * 63)]
    return rows + [(2005, [float("nan")] * 64), (2006, [0.0] * 63 + [float("inf")])]


@pytest.mark.parametrize(("seed", "size"), [(1, 300), (2, 300), (3, 0)])
def test_clusters_equal_brute_force(spark, seed, size):
    rows = cloud(seed, size) if size else [(i, [float(i % 3)] * 64) for i in range(20)]
    got = centroids.cluster(vectors(spark, rows)).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(brute_clusters(rows), key=key)


def test_clusters_of_few_or_no_vectors(spark):
    rows = [(1, [0.5] * 64), (2, [-0.5] * 64)]
    got = centroids.cluster(vectors(spark, rows)).collect()
    assert sorted((r.vec_id, r.distance) for r in got) == [(1, 0), (2, 0)] and len({r.cluster for r in got}) == 2
    empty = centroids.cluster(vectors(spark, rows).limit(0))
    assert empty.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert empty.count() == 0


def test_a_vector_without_an_exact_distance_is_an_error(spark):
    with pytest.raises(Exception, match="no exact distance"):
        centroids.cluster(vectors(spark, [(1, [1e30] * 64)])).collect()


def test_bounds_skip_distances_and_keep_every_cluster():
    rng = np.random.default_rng(5)
    middles = rng.normal(size=(16, 64)) * 64
    x = np.floor(middles[rng.integers(0, 16, 4000)] + rng.normal(size=(4000, 64)) * 20).astype(np.int64)
    history = [x[:16].copy()]
    state = (np.full(len(x), -1), np.zeros((len(x), 16), np.float32), np.zeros((len(x), 16), np.uint8))
    share = []
    for _ in range(6):
        *state, asked = centroids.assign(x, *state, history)
        plain = np.stack([centroids.squared(x, c) for c in history[-1]], axis=1)
        assert (state[0] == plain.argmin(axis=1)).all()
        share.append(asked / plain.size)
        new = history[-1].copy()
        for j in np.unique(state[0]):
            new[j] = x[state[0] == j].sum(axis=0) // (state[0] == j).sum()
        history.append(new)
    assert share[0] == 1 and share[-1] < 0.3


def test_total_displacement_is_no_more_than_the_summed_steps():
    rng = np.random.default_rng(6)
    history = [rng.integers(-50, 50, (16, 64)) for _ in range(5)]
    summed = sum(np.sqrt(((b - a).astype(float) ** 2).sum(axis=1)) for a, b in zip(history, history[1:]))
    total = centroids.moved(history)
    assert (total[0] <= summed + 1e-9).all() and (total[-1] == 0).all()
