"""Near-duplicate documents by a multi-index Hamming join of MinHash signatures.

A signature holds ``CHUNKS * SLOTS`` values of 16 bits, each from one MinHash.  Two
signatures that differ in fewer than ``CHUNKS * 2`` values agree, by the pigeonhole
principle, in all but one value of some chunk.  So every chunk is indexed under as
many keys as it has values, each leaving one value out: all pairs within that distance
share a key.  At a similarity of 0.8 no chunk agrees in all but one value with a
probability of about two in a million.

Documents with equal shingle sets are one class; only classes are compared.  A shingle
that one class alone has among those that share keys can't be in an intersection but is
in every union, so the counts of such shingles bound the similarity of a pair from above,
without a look at it.

Within keys, no pairs are written out.  First each class is compared with one hub, of
its keys' classes the one with the fewest shingles of its own; that links most.  A key is
settled once its classes, without those that the bound keeps from any link in it, lie in
one component.  The classes of the other keys form groups, connected by keys; a group is
dealt into blocks of bounded size, and each two of its blocks meet in one task, which
counts all intersections of their whole sets and writes only what links components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import landed
from gradeflow.llm.shingles import common, mixed, set_id, shingle_set

CHUNKS, SLOTS = 10, 5
#: Classes and shingles that a block of a group holds on average.
BLOCK_CLASSES, BLOCK_SHINGLES = 256, 1 << 17
#: Shingles that are hashed at a time.
SLICE = 1 << 15
#: Shingles that are counted at a time.
COLUMNS = 4096

_SEEDS = mixed(np.arange(1, CHUNKS * SLOTS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(_SEEDS) | np.uint64(1)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MinHash values of a set, 16 bits each."""
    least = np.full(len(_SEEDS), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), SLICE):
        part = (hashes[start : start + SLICE, None] ^ _SEEDS) * _FACTORS
        np.minimum(least, part.min(axis=0), out=least)
    return (mixed(least) >> np.uint64(48)).astype(np.uint16)


def describe(width: int):
    """doc_id, set size, class and signature of each text; its digest passes unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, classes, signatures = [], [], []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py(), width)
                sizes.append(len(hashes))
                classes.append(set_id(hashes) if len(hashes) else None)
                signatures.append(signature(hashes).tobytes() if len(hashes) else None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(classes, pa.binary()),
                    pa.array(signatures, pa.binary()),
                    batch.column(2),
                ],
                ["doc_id", "n_shingles", "class", "signature", "digest"],
            )

    return run


def leave_one_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of a class: for each chunk and each of its values, a hash of the others."""
    labels = mixed(np.arange(1, CHUNKS * SLOTS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
    for batch in batches:
        for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
            raw = b"".join(part.column(1).to_pylist())
            values = np.frombuffer(raw, np.uint16).reshape(-1, CHUNKS, SLOTS).astype(np.uint64)
            keys = np.empty((len(values), CHUNKS, SLOTS), np.uint64)
            for out in range(SLOTS):
                packed = np.zeros((len(values), CHUNKS), np.uint64)
                for i in range(SLOTS):
                    if i != out:
                        packed = (packed << np.uint64(16)) | values[:, :, i]
                keys[:, :, out] = packed
            keys = mixed(mixed(keys.reshape(len(values), -1)) + labels)
            take = pa.array(np.repeat(np.arange(len(values)), CHUNKS * SLOTS))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), part.column(0).take(take)], ["key", "node"]
            )


def sets_of(width: int):
    """The whole shingle set of each text, as bytes, with its class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
                sets = [shingle_set(text.as_py(), width) for text in part.column(1)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([set_id(s) if len(s) else None for s in sets], pa.binary()),
                        pa.array([s.tobytes() for s in sets], pa.binary()),
                    ],
                    ["wanted", "class", "hashes"],
                )

    return run


def confirm(percent: int):
    """Keeps the pairs whose sets have ``percent`` % of their union in common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), np.uint64) for v in (a, b))
                both = common(x, y)
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def components(edges: DataFrame) -> DataFrame:
    """node, root for all nodes of the written edges (a, b): equal roots where a path leads.

    Each round maps every node to the least of itself and its neighbours, and carries
    the edges over to these.  The classes are numbered in the order of their hashes, so a
    path shrinks by a constant factor.
    """
    edges = edges.select("a", "b")
    mapping = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = landed(both.groupBy("a").agg(F.least("a", F.min("b")).alias("least")))
        if mapping is None:
            mapping = step.select(F.col("a").alias("node"), F.col("least").alias("root"))
        else:
            moved = mapping.join(step, F.col("root") == F.col("a"), "left")
            mapping = moved.select("node", F.coalesce("least", "root").alias("root"))
        first = edges.join(step, "a").select(F.col("least").alias("x"), F.col("b"))
        second = first.join(step.withColumnRenamed("a", "b"), "b")
        edges = landed(
            second.filter("x <> least")
            .select(F.least("x", "least").alias("a"), F.greatest("x", "least").alias("b"))
            .distinct()
        )
    return edges.selectExpr("a as node", "b as root") if mapping is None else landed(mapping)


def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, shingle: all shingles of the sets."""
    for batch in batches:
        for part in (batch.slice(i, 500) for i in range(0, batch.num_rows, 500)):
            sets = [np.frombuffer(h.as_py(), np.int64) for h in part.column(1)]
            take = pa.array(np.repeat(np.arange(len(sets)), [len(s) for s in sets]))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(take), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64))],
                ["node", "shingle"],
            )


def linkable(members: DataFrame, docs: DataFrame, described: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """node, n, alone, hashes of the classes that share keys and can have a link.

    ``alone`` counts the shingles that no other such class has.
    """
    nodes = landed(members.select("node").distinct().join(classes, "node").select("node", "class", "doc_id"))
    # One document of each class; an id may be null or stand for several texts.
    ids = nodes.select(F.coalesce("doc_id", F.lit(-1)).alias("id")).distinct()
    texts = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("id"), "text").join(ids, "id", "left_semi")
    made = texts.select("id", "text").mapInArrow(sets_of(width), "wanted long, class binary, hashes binary")
    wanted = nodes.select("node", "class")
    sets = landed(made.join(wanted, "class").groupBy("node").agg(F.min("hashes").alias("hashes")))
    shingles = sets.select("node", "hashes").mapInArrow(exploded, "node long, shingle long")
    held = shingles.groupBy("shingle").agg(F.count("*").alias("n"), F.min("node").alias("node"))
    alone = held.filter("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
    known = sets.withColumn("n", (F.octet_length("hashes") / 8).cast("long")).join(alone, "node", "left")
    known = known.withColumn("alone", F.coalesce("alone", F.lit(0)))
    return landed(known.filter(100 * (F.col("n") - F.col("alone")) >= percent * F.col("n")))


def may_link(percent: int) -> F.Column:
    """Whether the bound lets node and hub be linked: shared shingles over a union with all others."""
    common_most = F.least(F.col("n") - F.col("alone"), F.col("hub_n") - F.col("hub_alone"))
    union_least = F.greatest(F.col("n") + F.col("hub_alone"), F.col("hub_n") + F.col("alone"))
    return 100 * common_most >= percent * union_least


def links(docs: DataFrame, described: DataFrame, classes: DataFrame, width: int, percent: int) -> DataFrame:
    """node, root of all classes that have a link."""
    keys = classes.select("node", "signature").mapInArrow(leave_one_out, "key long, node long")
    shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    members = landed(keys.join(shared.filter("least <> most").select("key"), "key"))
    sets = linkable(members, docs, described, classes, width, percent)
    members = landed(members.join(sets.select("node", "n", "alone"), "node"))

    best = members.groupBy("key").agg(F.min(F.struct("alone", "node", "n")).alias("h"))
    hubs = best.select("key", F.col("h.node").alias("hub"), F.col("h.n").alias("hub_n"), F.col("h.alone").alias("hub_alone"))
    pairs = members.join(hubs, "key").filter("node <> hub").filter(may_link(percent))
    pairs = pairs.groupBy("node").agg(F.min(F.struct("hub_alone", "hub")).alias("best")).select("node", "best.hub")
    left = sets.select("node", F.col("hashes").alias("x"))
    right = sets.select(F.col("node").alias("hub"), F.col("hashes").alias("y"))
    both = pairs.join(left, "node").join(right, "hub").select("node", "hub", "x", "y")
    found = landed(both.mapInArrow(confirm(percent), "a long, b long"))
    roots = components(found)

    labelled = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # Without the classes that can't be linked even with the one that has the fewest shingles alone.
    fewest = labelled.groupBy("key").agg(F.min("alone").alias("fewest"))
    alive = labelled.join(fewest, "key")
    alive = alive.filter(100 * (F.col("n") - F.col("alone")) >= percent * (F.col("n") + F.col("fewest")))
    state = alive.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.min("node").alias("first"))
    active = alive.join(state.filter("least <> most").select("key", "first"), "key")
    active = landed(active.groupBy("node", "first").agg(F.min("root").alias("root")))
    groups = components(active.select(F.col("first").alias("a"), F.col("node").alias("b")).filter("a <> b"))
    missed = landed(compared(active, groups, sets, percent))
    return roots if missed.isEmpty() else components(found.union(missed))


def compared(active: DataFrame, groups: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links between the components of each group, at least one where there are any."""
    roots = active.groupBy("node").agg(F.min("root").alias("root"))
    placed = groups.select("node", F.col("root").alias("group")).join(roots, "node")
    sized = placed.join(sets.select("node", "n"), "node")
    counts = sized.groupBy("group").agg(F.count("*").alias("classes"), F.sum("n").alias("shingles"))
    needed = F.greatest(F.col("classes") / BLOCK_CLASSES, F.col("shingles") / BLOCK_SHINGLES)
    counts = counts.select("group", F.ceil(needed).cast("int").alias("blocks"))
    dealt = placed.join(counts, "group").withColumn("block", F.pmod(F.hash("node"), "blocks"))
    whole = dealt.join(sets.select("node", "hashes"), "node").groupBy("group", "block")
    held = landed(whole.agg(F.collect_list(F.struct("node", "root", "hashes")).alias("rows"), F.min("blocks").alias("blocks")))
    later = F.explode(F.sequence("block", F.col("blocks") - 1)).alias("second")
    earlier = F.explode(F.sequence(F.lit(0), "block")).alias("first")
    left = held.select("group", F.col("block").alias("first"), F.col("rows").alias("x"), later)
    right = held.select("group", F.col("block").alias("second"), F.col("rows").alias("y"), earlier)
    met = left.join(right, ["group", "first", "second"]).select("x", "y")
    return met.mapInArrow(between(percent), "a long, b long")


def between(percent: int):
    """Links between the sets of two blocks, one for each two components at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                x, y = (pa.concat_arrays([batch.column(c)[row].values]) for c in (0, 1))
                a, b = linked(x, y, percent)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def linked(x: pa.StructArray, y: pa.StructArray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    numbers = lambda s, field: s.field(field).to_numpy(zero_copy_only=False)
    sets = [[np.frombuffer(h, np.uint64) for h in s.field("hashes").to_pylist()] for s in (x, y)]
    sizes = [np.array([len(h) for h in side], np.int64) for side in sets]
    tokens = [np.concatenate(side) for side in sets]
    owners = [np.repeat(np.arange(len(n)), n) for n in sizes]
    shared = np.intersect1d(*tokens)
    places = []
    for token, owner in zip(tokens, owners):
        at = np.searchsorted(shared, token)
        at[at == len(shared)] = 0
        keep = shared[at] == token if len(shared) else np.zeros(len(token), bool)
        places.append((at[keep], owner[keep]))
    counts = np.zeros((len(sizes[0]), len(sizes[1])), np.float32)
    for start in range(0, len(shared), COLUMNS):
        sides = []
        for (at, owner), n in zip(places, sizes):
            here = (at >= start) & (at < start + COLUMNS)
            held = np.zeros((len(n), min(COLUMNS, len(shared) - start)), np.float32)
            held[owner[here], at[here] - start] = 1
            sides.append(held)
        counts += sides[0] @ sides[1].T
    both = counts.astype(np.int64)
    close = 100 * both >= percent * (sizes[0][:, None] + sizes[1] - both)
    roots = [numbers(s, "root") for s in (x, y)]
    i, j = np.nonzero(close & (roots[0][:, None] != roots[1]))
    ends = np.sort(np.stack([roots[0][i], roots[1][j]]), axis=0)
    _, first = np.unique(ends, axis=1, return_index=True) if len(i) else (None, np.empty(0, np.int64))
    return numbers(x, "node")[i[first]], numbers(y, "node")[j[first]]


def near_duplicates(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``.

    A text's set are its distinct runs of ``width`` words, or all its words if they are
    fewer.  Rows whose sets have ``percent`` % of their union in common are linked, and
    component_id is the smallest id that links reach.  Texts that are null or without
    words are linked with nothing and keep their own id.  Rows with one id and several
    texts are linked text by text; a null id is never the smallest unless all are null,
    and such rows are not kept.  An empty table gives no rows.  Other columns are ignored.
    """
    grouped = classified(docs, width, percent)
    component = F.coalesce("component_id", "doc_id")
    return grouped.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(False)).alias("kept")
    )


def classified(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class, digest of the text, root, component_id; class, root and the last null without words."""
    docs = docs.select(F.col("doc_id").cast("long"), "text", _digest())
    shape = "doc_id long, n_shingles long, class binary, signature binary, digest binary"
    described = landed(docs.mapInArrow(describe(width), shape))
    classes = described.filter("class is not null").groupBy("class")
    classes = classes.agg(F.min("doc_id").alias("doc_id"), F.min("signature").alias("signature"))
    # Numbers are shorter than names; they stay as they are once written.
    classes = landed(classes.withColumn("node", F.monotonically_increasing_id()))
    roots = links(docs, described, classes, width, percent)
    rooted = classes.select("class", "node", "doc_id").join(roots, "node", "left")
    rooted = landed(rooted.select("class", "doc_id", F.coalesce("root", "node").alias("root")))
    least = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    ids = rooted.select("class", "root").join(least, "root")
    return described.select("doc_id", "n_shingles", "class", "digest").join(ids, "class", "left")


def one_of_each(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each group one with the smallest id.

    Texts without words are groups of their own for each id.  Of rows with one id and one
    shingle set, and of a group whose ids are all null, one row is kept.
    """
    columns = docs.columns
    found = classified(docs, width, percent)
    # The class to keep of each group: that of its smallest id, by name among several.
    # An id may stand for several texts, and a class for several of an id's: the digest tells which to keep.
    named = found.select("root", _none(), _id(), "class", F.col("digest").alias("_digest"))
    key = ["_none", "_id", "_digest"]
    chosen = F.min(F.struct("_none", "_id", "class", "_digest")).alias("best")
    best = named.filter("class is not null").groupBy("root").agg(chosen)
    wordless = named.filter("class is null").groupBy("_none", "_id").agg(F.min("_digest").alias("_digest"))
    keep = landed(best.select(*[f"best.{c}" for c in key]).union(wordless))
    # One shuffle, after each task has dropped its own repeated rows, serves both steps.
    texts = docs.select("*", _none(), _id(), _digest().alias("_digest"))
    return texts.dropDuplicates(key).join(keep, key, "left_semi").select(columns)


def _none() -> F.Column:
    return F.col("doc_id").isNull().alias("_none")


def _id() -> F.Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("_id")


def _digest() -> F.Column:
    """32 bytes that name a text: equal for equal texts, null counting as empty."""
    return F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias("digest")
