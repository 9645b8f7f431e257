"""The trie of conversation prefixes by range partitions and a splitter skeleton.

A conversation is the path of its turns, each 16 bytes of a hash.  Paths are sorted and cut into
shards at splitters, members of a sample, that are pairs of path and id, so that copies of one
conversation can be cut as well.  A prefix of no splitter has all its members in one shard,
which finishes its node while it reads its sorted members once.  The prefixes of splitters, the
skeleton, go to every task as a trie of as many nodes as there are shards times turns; of them
each shard has a partial aggregate, and the partial aggregates of a node are added up.

What is in memory is the path that is being read and the unfinished children along it.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeflow.llm.common import in_share, landed

#: Bytes of a turn in a path.
TURN = 16
#: Conversations of a shard, as long as there are no more than SHARDS_A_PARTITION shards a partition.
SHARD = 1024
SHARDS_A_PARTITION = 4
#: Sampled conversations a splitter is chosen from.
SAMPLED = 16
#: Ids that a partial list of ends holds at most.
ENDS = 1 << 14
#: A conversation begins with up to HEAD - 1 turns of the first one of its FAMILY.
HEAD, FAMILY = 6, 100

NOTHING = hashlib.sha256(b"").hexdigest()
NODE = "conv_id long, depth long, n_convs long, n_children long, n_leaves long, saved_tokens long"
#: kind 0: a node, with its parent's conv_id or else skeleton node; 1: a partial skeleton node; 2: some of its ends.
FOUND = f"kind int, node binary, parent binary, parent_conv_id long, {NODE}, size long, ends string"


def turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, hash, size of every row with a conv_id; a null role or text is an empty one."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    # The role's length keeps role and text apart.
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.md5(named.cast("binary")).alias("hash"),
        F.length(text).alias("size"),
    )
    return rows.filter("conv_id is not null")


def paths(conversations: DataFrame) -> DataFrame:
    """conv_id, path, sizes of every rebuilt conversation.

    Turns are hashed before they move, and move once, by the first id of the family.  A family
    has at most ``FAMILY`` conversations, twice as many around 0.
    """
    rows = turns(conversations).withColumn("family", F.col("conv_id") - F.col("conv_id") % FAMILY)
    # Null turns first; equal turns by their hash.
    turn = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("turn"), "hash", "size")
    own = rows.repartition("family").groupBy("family", "conv_id").agg(F.array_sort(F.collect_list(turn)).alias("own"))
    heads = own.filter("conv_id = family").select(F.col("family").alias("_family"), F.slice("own", 1, HEAD - 1).alias("head"))
    both = own.join(heads, F.col("family") == F.col("_family"), "left")
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEAD).cast("int")
    begun = F.when(F.col("head").isNotNull(), F.slice("head", F.lit(1), taken)).otherwise(F.slice("own", 1, 0))
    whole = F.concat(begun, F.slice("own", taken + 1, F.size("own")))
    hashes = F.array_join(F.transform(whole, lambda t: t["hash"]), "")
    return both.select("conv_id", F.unhex(hashes).alias("path"), F.transform(whole, lambda t: t["size"]).alias("sizes"))


def splitters(rows: DataFrame, shard: int) -> list[tuple[bytes, int]]:
    """The first (path, id) of all shards but the first, from a sample of ``SAMPLED`` rows a shard."""
    count = rows.count()
    most = SHARDS_A_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = min(-(-count // shard), most)
    if shards < 2:
        return []
    some = rows.filter(in_share(shards * SAMPLED / count, "conv_id"))
    order = [(bytes(r.path), r.conv_id) for r in some.select("path", "conv_id").orderBy("path", "conv_id").toLocalIterator()]
    return [order[i * len(order) // shards] for i in range(1, shards)] if len(order) >= shards else order


def shared(a: bytes, b: bytes) -> int:
    """Turns that two paths begin with in common."""
    most = min(len(a), len(b)) // TURN
    low, high = 0, most
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * TURN] == b[: middle * TURN] else (low, middle - 1)
    return low


def name_of(path: bytes, depth: int) -> bytes:
    return hashlib.md5(path[: depth * TURN]).digest()


def skeleton(cuts: list[tuple[bytes, int]]) -> dict[bytes, bytes | None]:
    """Names of all prefixes of the splitters' paths, with their parents' names; the root's is null."""
    out: dict[bytes, bytes | None] = {name_of(b"", 0): None}
    last = b""
    for path, _ in cuts:
        for depth in range(shared(last, path) + 1, len(path) // TURN + 1):
            out[name_of(path, depth)] = name_of(path, depth - 1)
        last = path
    return out


@dataclass(slots=True)
class _Open:
    """A node whose members are being read."""

    depth: int
    size: int
    skeleton: bool
    least: int | None = None
    members: int = 0
    children: int = 0
    leaves: int = 0
    saved: int = 0
    ends: list[int] = field(default_factory=list)
    digest: object = None
    waiting: list[dict] = field(default_factory=list)


def shard_nodes(rows: Iterable[tuple[int, bytes, list[int]]], left: bytes | None, right: bytes | None) -> Iterator[dict]:
    """Finished nodes and partial skeleton nodes of one shard's (id, path, sizes) in order.

    ``left`` and ``right`` are the splitters' paths on both sides, null at the ends.
    """
    before = b""
    stack = [_Open(0, 0, True)]

    def flush(top: _Open) -> dict:
        text = ",".join(map(str, top.ends))
        made = {"kind": 2, "node": name_of(before, top.depth), "conv_id": top.ends[0], "ends": text}
        top.ends.clear()
        return made

    def close(depth: int) -> Iterator[dict]:
        while len(stack) > depth:
            top = stack.pop()
            parent = stack[-1] if stack else None
            if top.skeleton:
                if top.ends:
                    yield flush(top)
            else:
                top.leaves = top.leaves or 1
                top.saved += (top.members - 1) * top.size
            made = {
                "kind": int(top.skeleton),
                "conv_id": top.least,
                "depth": top.depth,
                "n_convs": top.members,
                "n_children": top.children,
                "n_leaves": top.leaves,
                "saved_tokens": top.saved,
                "size": top.size,
            }
            for child in top.waiting:
                child["parent_conv_id"] = top.least
                yield child
            if parent:
                parent.members += top.members
                parent.least = top.least if parent.least is None else min(parent.least, top.least)
            if top.skeleton:
                made["node"] = name_of(before, top.depth)
                made["parent"] = name_of(before, top.depth - 1) if top.depth else None
                yield made
                continue
            made["ends"] = _ended(top)
            parent.children += 1
            parent.leaves += top.leaves
            parent.saved += top.saved
            if parent.skeleton:
                made["parent"] = name_of(before, parent.depth)
                yield made
            else:
                parent.waiting.append(made)

    for conv_id, path, sizes in rows:
        same = shared(before, path)
        yield from close(same + 1)
        length = len(path) // TURN
        if length > same:
            split = max((shared(path, cut) for cut in (left, right) if cut is not None), default=0)
            for depth in range(same + 1, length + 1):
                stack.append(_Open(depth, sizes[depth - 1], depth <= split))
        before = path
        top = stack[-1]
        top.members += 1
        top.least = conv_id if top.least is None else min(top.least, conv_id)
        top.ends.append(conv_id)
        if len(top.ends) == ENDS:
            if top.skeleton:
                yield flush(top)
            else:
                _digest(top)
    yield from close(0)


def _digest(top: _Open) -> None:
    """Moves the ends read so far into the node's digest."""
    text = ",".join(map(str, top.ends))
    if top.digest is None:
        top.digest = hashlib.sha256()
    else:
        text = "," + text
    top.digest.update(text.encode())
    top.ends.clear()


def _ended(top: _Open) -> str:
    if top.ends:
        _digest(top)
    return top.digest.hexdigest() if top.digest else NOTHING


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


_ARROW = pa.schema(
    [
        ("kind", pa.int32()),
        ("node", pa.binary()),
        ("parent", pa.binary()),
        ("parent_conv_id", pa.int64()),
        *[(name, pa.int64()) for name in ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "size")],
        ("ends", pa.string()),
    ]
)


def _sharded(rows: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    """The rows with their shard's number, dealt out by it and sorted."""
    known = rows.sparkSession.sparkContext.broadcast(cuts)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shards = pa.array([bisect_right(known.value, pair) for pair in pairs], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], ["conv_id", "path", "sizes", "shard"])

    dealt = rows.mapInArrow(number, "conv_id long, path binary, sizes array<int>, shard int")
    return dealt.repartition(len(cuts) + 1, "shard").sortWithinPartitions("shard", "path", "conv_id")


def _read(sharded: DataFrame, cuts: list[tuple[bytes, int]]) -> DataFrame:
    known = sharded.sparkSession.sparkContext.broadcast([path for path, _ in cuts])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ahead: list[tuple] = []

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*[batch.column(i).to_pylist() for i in range(4)])

        source = rows()

        def of_shard(first: tuple) -> Iterator[tuple]:
            yield first[:3]
            for row in source:
                if row[3] != first[3]:
                    ahead.append(row)
                    return
                yield row[:3]

        def nodes() -> Iterator[dict]:
            ahead.extend([first] if (first := next(source, None)) else [])
            while ahead:
                first = ahead.pop()
                paths, shard = known.value, first[3]
                left = paths[shard - 1] if shard else None
                right = paths[shard] if shard < len(paths) else None
                yield from shard_nodes(of_shard(first), left, right)

        yield from _batches(nodes(), _ARROW)

    return sharded.mapInArrow(run, FOUND)


def _ends(chunks: DataFrame) -> DataFrame:
    """node, ends_sha256 of the skeleton nodes' lists of ends.

    A digest reads its ids in order, however many: they pass through its task in lists of up
    to ``ENDS``, one at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, None
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(2)):
                if name != node:
                    if node is not None:
                        yield made(node, digest)
                    node, digest = name, hashlib.sha256(text.as_py().encode())
                else:
                    digest.update(f",{text.as_py()}".encode())
        if node is not None:
            yield made(node, digest)

    def made(node: bytes, digest) -> pa.RecordBatch:
        columns = [pa.array([node], pa.binary()), pa.array([digest.hexdigest()], pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["node", "ends_sha256"])

    lists = chunks.select("node", "conv_id", "ends").repartition("node").sortWithinPartitions("node", "conv_id")
    return lists.mapInArrow(run, "node binary, ends_sha256 string")


def _above(nodes: DataFrame, trie: dict[bytes, bytes | None]) -> DataFrame:
    """node, n_leaves, saved_tokens once for each node and each one above it."""
    known = nodes.sparkSession.sparkContext.broadcast(trie)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, leaves, saved in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                above = []
                while name is not None:
                    above.append(name)
                    name = known.value[name]
                columns = [pa.array(above, pa.binary()), pa.array([leaves] * len(above)), pa.array([saved] * len(above))]
                yield pa.RecordBatch.from_arrays(columns, ["node", "n_leaves", "saved_tokens"])

    return nodes.select("node", "n_leaves", "saved_tokens").mapInArrow(run, "node binary, n_leaves long, saved_tokens long")


def _reduced(found: DataFrame, trie: dict[bytes, bytes | None]) -> DataFrame:
    """The skeleton's nodes from their partial aggregates."""
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    nodes = found.filter("kind = 1").groupBy("node").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.max("size").alias("size"), F.min("conv_id").alias("conv_id"), *sums
    )
    nodes = landed(nodes)
    # A skeleton node is counted among its parent's children here, once however many shards hold it.
    inner = nodes.groupBy(F.col("parent").alias("_node")).agg(F.count("*").alias("inner"))
    nodes = nodes.join(inner, F.col("node") == F.col("_node"), "left")
    children = F.col("n_children") + F.coalesce("inner", F.lit(0))
    nodes = landed(
        nodes.select(
            "node",
            "parent",
            "depth",
            "conv_id",
            "n_convs",
            children.alias("n_children"),
            (F.col("n_leaves") + F.when(children == 0, 1).otherwise(0)).alias("n_leaves"),
            (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"),
        )
    )
    totals = _above(nodes, trie).groupBy("node").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ends = _ends(found.filter("kind = 2"))
    rows = nodes.drop("n_leaves", "saved_tokens").join(totals, "node").join(ends, "node", "left")
    return landed(rows.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))))


def trie(conversations: DataFrame, shard: int = SHARD) -> DataFrame:
    """One row per node of the trie of rebuilt conversations.

    conv_id (the smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256, as the query's contract names them.  Rows with a null
    conv_id belong to no conversation and are left out.  Turns are ordered by ``turn``, null
    first, equal ones by a hash of role and text, and repeated rows are turns of their own.  A
    remainder has its id's sign, so -7 is of family 0.  An empty table has no conversation and no
    node.  Other columns are ignored.  A conversation's hashes, 24 bytes a turn, are one row.
    """
    rows = landed(paths(conversations))
    cuts = splitters(rows, shard)
    known = skeleton(cuts)
    found = landed(_read(_sharded(rows, cuts), cuts))
    inner = _reduced(found, known)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    # As many as the skeleton that the tasks have got already.
    parents = F.broadcast(inner.select(F.col("node").alias("_node"), F.col("conv_id").alias("_conv_id")))
    local = found.filter("kind = 0").join(parents, F.col("parent") == F.col("_node"), "left")
    parent = F.coalesce("parent_conv_id", "_conv_id").alias("parent_conv_id")
    made = local.withColumnRenamed("ends", "ends_sha256").select(*[parent if c == "parent_conv_id" else c for c in columns])
    above = inner.join(parents, F.col("parent") == F.col("_node"), "left").withColumnRenamed("_conv_id", "parent_conv_id")
    return made.unionByName(above.select(*columns))


TRIE_SQL = """
with recursive steps as (
  select cast(i as bigint) as i, cast(i as bigint) as x, 0 as k from range(256) t(i)
  union all
  select i, case when x % 2 = 1 then xor(x // 2, 3988292384) else x // 2 end, k + 1 from steps where k < 8),
bytes as (select list(x order by i) as step from steps where k = 8),
turns as (
  select cast(conv_id as bigint) as c, turn, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first,
      md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) as p
  from conversations where conv_id is not null),
convs as (
  select c, c - c % 100 as f, 4294967295 as start, cast(c as varchar) as name from (select distinct c from turns)),
hashed as (
  select c, f, cast(xor(list_reduce(list_concat([start], list_transform(string_split(name, ''), lambda ch: cast(ascii(ch) as bigint))),
    lambda h, b: xor(h // 256, step[cast(xor(h, b) % 256 as integer) + 1])), 4294967295) as bigint) % 6 as h
  from convs, bytes),
rebuilt as (
  select hashed.c, turns.p, turns.role, turns.text from hashed join turns on turns.c = hashed.f and turns.p <= hashed.h
  union all
  select hashed.c, 1000000 + turns.p, turns.role, turns.text from hashed join turns on turns.c = hashed.c and turns.p > hashed.h),
placed as (
  select c, row_number() over (partition by c order by p) as d, length(text) as size,
    md5(length(role) || ':' || role || text) as turn from rebuilt),
chains as (
  select c, d, size, string_agg(turn, '') over (partition by c order by d) as key from placed
  union all
  select c, 0, 0, '' from hashed),
members as (
  select key, d, min(size) as size, min(c) as conv_id, count(*) as n_convs from chains group by key, d),
lengths as (select c, max(d) as len from chains group by c),
ends as (
  select key, string_agg(cast(c as varchar), ',' order by c) as ids
  from chains join lengths using (c) where d = len group by key),
family as (
  select members.*, left(key, cast(greatest((d - 1) * 32, 0) as bigint)) as parent, (n_convs - 1) * size as own from members),
children as (select parent as key, count(*) as n from family where d > 0 group by parent),
leaves as (
  select family.*, coalesce(children.n, 0) as n_children, case when children.n is null then 1 else 0 end as leaf
  from family left join children using (key)),
above as (select leaf, own, left(key, unnest(range(0, d + 1)) * 32) as key from leaves),
sums as (select key, sum(leaf) as n_leaves, sum(own) as saved from above group by key)
select l.conv_id, cast(l.d as bigint) as depth, case when l.d > 0 then p.conv_id end as parent_conv_id,
  cast(l.n_convs as bigint) as n_convs, cast(l.n_children as bigint) as n_children,
  cast(s.n_leaves as bigint) as n_leaves, cast(s.saved as bigint) as saved_tokens,
  sha256(coalesce(e.ids, '')) as ends_sha256
from leaves l join members p on p.key = l.parent join sums s on s.key = l.key left join ends e on e.key = l.key
"""
