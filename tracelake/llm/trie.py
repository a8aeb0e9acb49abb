"""Prefix trie of conversations by a splitter skeleton.

1. Turns become digests of (role, text) with the text's size; a conversation is
   the string of its turns' digests.  Positions come from
   ``plans.ordering.with_position``, which splits a conversation of any length.
2. Strings are held in blocks of at most ``BLOCK`` turns.  A block belongs to the
   node at which it starts, named by a hash of everything before it, so the blocks
   below one node are a trie of their own, of bounded depth.  Nearly all
   conversations are one block.
3. Range partition: a sample of (node, string, conversation), drawn by hash, gives
   the splitters.  Copies of one string are parted by the conversation id.  The
   splitters' own paths, the skeleton, are broadcast; at most ``SPLITTER_BYTES``.
4. Each shard is sorted and finishes every node that is on no splitter's path:
   all its members lie in this shard.  For a node of the skeleton, a shard gives
   a partial row; these are added up by key, which are at most (shards x block)
   keys, and the sums are handed down the skeleton.
5. Long conversations: blocks whose start node has one member are finished by
   themselves; the others level by level, from the deepest, each handing leaves
   and savings to the level above.

The ids that end at a node are hashed as one string; each shard joins its own, and
a node's parts follow each other through one running hash, so no task holds them.

Defined results: rows with a null conversation id belong to none and are left
out; null roles and texts are empty; turns that tie are ordered by the digest of
role and text; repeated rows are turns of their own; a table of no rows has no
nodes, not even a root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracelake.llm.common import cut
from tracelake.plans.ordering import with_position
from tracelake.session import shuffle_partitions

BLOCK = 1024  # turns of a block
WIDTH = 16  # bytes of a turn's digest
DRAWN = 64  # sampled strings per shard
SPLITTER_BYTES = 16_000_000  # of sampled strings, all together
SHARD_BYTES = 8_000_000  # of strings in a shard
ID_PART = 100_000  # ids in one part of an ends string

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"


def turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, digest, bytes``: role and text as a digest."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    both = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(both.cast("binary"), 256)), 1, WIDTH)
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes"),
    )


def in_order(own: DataFrame) -> DataFrame:
    """Turns (of ``turns``) with their ``depth``, from 1, in their conversation."""
    placed = with_position(own, [F.col("turn").asc_nulls_first(), F.col("digest"), F.col("bytes")], "depth", group=["conv_id"])
    return placed.drop("turn")


def rebuilt(placed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The given rebuilding: the first h turns of conversation ``c - c % 5``,
    then c's own after its first h, with ``h = crc32(c) % 9``.  Returns the turns
    and all conversations with their length."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9
    lengths = placed.groupBy("conv_id").agg(F.max("depth").alias("own"))
    base = lengths.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    convs = lengths.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5)
    convs = convs.join(base, "base", "left")
    convs = cut(convs.withColumn("taken", F.least(F.col("h"), F.coalesce("there", F.lit(0)))))
    kept = placed.where(F.col("depth") > h).join(convs.select("conv_id", "h", "taken"), "conv_id")
    kept = kept.select("conv_id", (F.col("taken") + F.col("depth") - F.col("h")).alias("depth"), "digest", "bytes")
    # at most eight turns of a base, for at most five conversations
    heads = placed.where((F.col("conv_id") % 5 == 0) & (F.col("depth") <= 8)).withColumnRenamed("conv_id", "base")
    heads = heads.join(convs.select("conv_id", "base", "taken"), "base").where(F.col("depth") <= F.col("taken"))
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    return (
        kept.unionByName(heads.select("conv_id", "depth", "digest", "bytes")),
        convs.select("conv_id", length.alias("length")),
    )


def blocks(turns: DataFrame, convs: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation and block, also for an empty last one: ``conv_id,
    level, top`` (a hash of all turns before), ``after`` (with the block's own),
    ``path`` and ``sizes`` (digests, and text sizes, end to end) and ``ends``, whether
    the conversation's last turn is the block's."""
    turn = F.struct("depth", "digest", "bytes")
    rows = turns.select("conv_id", F.floor((F.col("depth") - 1) / block).alias("level"), turn.alias("turn"))
    rows = rows.withColumn("ends", F.lit(False))
    none = F.lit(None).cast(rows.schema["turn"].dataType)
    last = F.floor(F.col("length") / block)
    full = (F.col("length") > 0) & (F.col("length") % block == 0)
    levels = F.when(full, F.array(last - 1, last)).otherwise(F.array(last))
    ends = convs.select("conv_id", F.explode(levels).alias("level"), none.alias("turn"), F.lit(True).alias("ends"))
    held = rows.unionByName(ends).groupBy("conv_id", "level").agg(
        F.array_sort(F.collect_list("turn")).alias("turns"), F.max("ends").alias("ends")
    )
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    held = held.select("conv_id", "level", path.alias("path"), F.transform("turns", lambda t: t["bytes"]).alias("sizes"), "ends")
    # the hash of all blocks up to here: each with its level, so their order counts
    name = F.sha2(F.concat(F.concat(F.col("level").cast("string"), F.lit(":")).cast("binary"), F.col("path")), 256)
    for i, column in ((1, "_a"), (16, "_b")):
        held = held.withColumn(column, F.conv(F.substring(name, i, 15), 16, 10).cast("long"))
    earlier = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
    for column in ("_a", "_b"):
        held = held.withColumn(f"{column}0", F.coalesce(F.bit_xor(column).over(earlier), F.lit(0)))
    top = F.concat_ws(".", F.col("level"), F.col("_a0"), F.col("_b0"))
    after = F.concat_ws(".", F.col("level") + 1, F.col("_a0").bitwiseXOR(F.col("_a")), F.col("_b0").bitwiseXOR(F.col("_b")))
    return held.select("conv_id", "level", top.alias("top"), after.alias("after"), "path", "sizes", "ends")


# ------------------------------------------------------------- one level


@dataclass
class Splitters:
    """Sorted ``(top, path, conv_id)``: shard i holds what lies from splitter
    i - 1 to below splitter i.  Their paths are the skeleton."""

    at: list[tuple[str, bytes, int]]

    def shard(self, top: str, path: bytes, conv: int) -> int:
        return bisect_right(self.at, (top, path, conv))

    def shared(self, shard: int) -> list[tuple[str, bytes]]:
        """The paths whose nodes a shard may share with others."""
        return [(top, path) for top, path, _ in self.at[max(shard - 1, 0) : shard + 1]]


def draw(level: DataFrame, shards: int | None = None) -> Splitters:
    """Quantiles of a sample of the strings, weighted by their length."""
    weight = F.length("path") + WIDTH
    total, n = level.agg(F.sum(weight), F.count(F.lit(1))).first()
    if not n:
        return Splitters([])
    shards = shards or max(shuffle_partitions(level.sparkSession), -(-total // SHARD_BYTES))
    share = min(1.0, DRAWN * shards / n, SPLITTER_BYTES / total)
    drawn = level.where(F.pmod(F.xxhash64("conv_id", "top"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1))
    rows = sorted((r["top"], bytes(r["path"]), r["conv_id"]) for r in drawn.select("top", "path", "conv_id").collect())
    weights = [len(path) + WIDTH for _, path, _ in rows]
    found, held = [], 0
    step = sum(weights) / shards
    for row, w in zip(rows, weights, strict=True):
        if held >= step * (len(found) + 1) and len(found) < shards - 1:
            found.append(row)
        held += w
    return Splitters(found)


def ends_hash(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


NO_ENDS = ends_hash([])


def key_of(top: str, prefix: bytes) -> str:
    return f"{top}/{hashlib.sha256(prefix).hexdigest()}"


def common(a: bytes, b: bytes) -> int:
    """The number of turns that two strings begin with alike."""
    low, high = 0, min(len(a), len(b)) // WIDTH
    while low < high:
        middle = (low + high + 1) // 2
        if a[: middle * WIDTH] == b[: middle * WIDTH]:
            low = middle
        else:
            high = middle - 1
    return low


class Node:
    """A node of the path that a scan is on."""

    __slots__ = ("children", "conv", "ends", "finished", "leaves", "n", "saved", "stub")

    def __init__(self, conv: int):
        self.conv, self.n, self.children, self.leaves, self.saved = conv, 0, 0, 0, 0
        self.stub = (0, 0, 0)  # children, leaves and savings in the level below
        self.ends: list[int] = []
        self.finished: list[tuple] = []  # children that wait for this node's smallest member


# FINISHED: a node, all but its parent's id if ``up`` names a node of the skeleton.
# PARTIAL: a shard's part of a node of the skeleton.  ENDS: ids that end at one.
# TOP: the start node of a level below the first, for the level above.
FINISHED, PARTIAL, ENDS, TOP = 0, 1, 2, 3
COLUMNS = {
    "kind": "int", "shard": "int", "key": "string", "up": "string", "top": "string", "conv_id": "long", "depth": "long",
    "parent_conv_id": "long", "n_convs": "long", "n_children": "long", "n_leaves": "long", "saved_tokens": "long",
    "ends_sha256": "string", "bytes": "long", "below_children": "long", "below_leaves": "long", "below_saved": "long",
    "part": "int", "ids": "string",
}
ROW = ", ".join(f"{name} {kind}" for name, kind in COLUMNS.items())


class Scan:
    """Turns a sorted run of ``(shard, top, path, conv_id, level, sizes, ends, stub)``
    into rows ``COLUMNS``; ``stub`` is of the node that a full block ends in."""

    def __init__(self, splitters: Splitters, block: int):
        self.splitters, self.block = splitters, block
        self.stack: list[Node] = []
        self.shard, self.top, self.level = -1, "", 0
        self.path, self.sizes = b"", []
        self.shared = -1  # the depth to which the path runs along a splitter's
        self.out: list[dict] = []

    def row(self, **values) -> None:
        self.out.append(values)

    def add(self, shard, top, path, conv, level, sizes, ends, stub) -> None:
        if (shard, top) != (self.shard, self.top) or not self.stack:
            self.finish()
            self.shard, self.top, self.level = shard, top, level
            self.stack = [Node(conv)]
            same = 0
        else:
            same = common(self.path, path)
            self.close(same + 1)
        self.path, self.sizes = path, sizes
        bounds = self.splitters.shared(shard)
        self.shared = max((common(path, p) for t, p in bounds if t == top), default=-1)
        self.stack += [Node(conv) for _ in range(same, len(path) // WIDTH)]
        for node in self.stack:
            node.n += 1
            node.conv = min(node.conv, conv)
        if ends:
            self.stack[-1].ends.append(conv)
        if stub is not None:
            self.stack[-1].stub = stub

    def finish(self) -> None:
        self.close(0)

    def close(self, least: int) -> None:
        """Takes the nodes from depth ``least`` on off the path, deepest first."""
        while len(self.stack) > least:
            depth = len(self.stack) - 1
            node = self.stack.pop()
            size = self.sizes[depth - 1] if depth else 0
            at = self.level * self.block + depth
            if depth <= self.shared:
                self.partial(node, depth, at, size)
                continue
            children = node.children + node.stub[0]
            leaves = node.leaves + node.stub[1]
            saved = node.saved + node.stub[2] + (node.n - 1) * size
            if depth or not self.level:
                leaves = leaves if children else 1
            for row in node.finished:
                self.finished(row, parent_conv_id=node.conv)
            row = (node.conv, at, node.n, children, leaves, saved, ends_hash(node.ends) if node.ends else NO_ENDS)
            if depth:
                parent = self.stack[-1]
                parent.children += 1
                parent.leaves += leaves
                parent.saved += saved
                if depth - 1 <= self.shared:
                    self.finished(row, up=key_of(self.top, self.path[: (depth - 1) * WIDTH]))
                else:
                    parent.finished.append(row)
            elif self.level:
                self.row(kind=TOP, top=self.top, n_children=children, n_leaves=leaves, saved_tokens=saved)
            else:
                self.finished(row)

    def finished(self, row: tuple, **more) -> None:
        names = ("conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
        self.row(kind=FINISHED, **dict(zip(names, row, strict=True)), **more)

    def partial(self, node: Node, depth: int, at: int, size: int) -> None:
        key = key_of(self.top, self.path[: depth * WIDTH])
        self.row(
            kind=PARTIAL, key=key, up=key_of(self.top, self.path[: (depth - 1) * WIDTH]) if depth else None,
            top=self.top if self.level and not depth else None, conv_id=node.conv, depth=at, n_convs=node.n,
            n_children=node.children, n_leaves=node.leaves, saved_tokens=node.saved, bytes=size,
            below_children=node.stub[0], below_leaves=node.stub[1], below_saved=node.stub[2],
        )
        for i in range(0, len(node.ends), ID_PART):
            ids = ",".join(map(str, node.ends[i : i + ID_PART]))
            self.row(kind=ENDS, shard=self.shard, key=key, part=i // ID_PART, ids=ids)

    def take(self):
        """An Arrow batch of the rows made since the last."""
        import pyarrow as pa

        types = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
        rows, self.out = self.out, []
        arrays = [pa.array([r.get(c) for r in rows], types[t]) for c, t in COLUMNS.items()]
        return pa.RecordBatch.from_arrays(arrays, names=list(COLUMNS))


def scan_level(level: DataFrame, splitters: Splitters, block: int) -> DataFrame:
    """All rows of ``COLUMNS`` that the shards of a level give."""
    shared = level.sparkSession.sparkContext.broadcast(splitters)  # at most SPLITTER_BYTES

    def deal(batches: Iterator) -> Iterator:
        import pyarrow as pa

        own = shared.value
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("top", "path", "conv_id")), strict=True)
            shards = pa.array([own.shard(*key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, shards], names=[*batch.schema.names, "shard"])

    def run(batches: Iterator) -> Iterator:
        scan = Scan(shared.value, block)
        names = ("shard", "top", "path", "conv_id", "level", "sizes", "ends")
        for batch in batches:
            below = zip(*(batch.column(c).to_pylist() for c in ("b_children", "b_leaves", "b_saved")), strict=True)
            for *row, stub in zip(*(batch.column(c).to_pylist() for c in names), below, strict=True):
                scan.add(*row, stub if stub[0] is not None else None)
                if len(scan.out) > 10_000:
                    yield scan.take()
            if scan.out:
                yield scan.take()
        scan.finish()
        yield scan.take()

    kinds = "conv_id long, level long, top string, path binary, sizes array<long>, ends boolean, b_children long, b_leaves long, b_saved long"
    names = [c.split()[0] for c in kinds.split(", ")]
    dealt = level.select(*names).mapInArrow(deal, kinds + ", shard int")
    dealt = dealt.repartitionById(len(splitters.at) + 1, F.col("shard"))
    return dealt.sortWithinPartitions("shard", "top", "path", "conv_id").mapInArrow(run, ROW)


def skeleton(found: DataFrame) -> tuple[list[tuple], list[tuple], list[tuple]]:
    """The nodes of the skeleton, complete but for their ends: ``(key, conv_id,
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens)``, the
    start nodes of a deeper level: ``(top, children, leaves, saved)``, and the
    smallest member of both: ``(key, conv_id)``.

    The partial rows are added up by key; what is left, one row per turn of a
    splitter at most, is handed up the skeleton here."""
    partial = found.where(F.col("kind") == PARTIAL).groupBy("key").agg(
        F.first("up").alias("up"), F.first("top").alias("top"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
        *[F.max(c).alias(c) for c in ("bytes", "below_children", "below_leaves", "below_saved")],
    )
    nodes = {r["key"]: r.asDict() for r in partial.collect()}
    done, tops = [], []
    for key, node in sorted(nodes.items(), key=lambda x: -x[1]["depth"]):
        children = node["n_children"] + node["below_children"]
        leaves = node["n_leaves"] + node["below_leaves"]
        saved = node["saved_tokens"] + node["below_saved"] + (node["n_convs"] - 1) * node["bytes"]
        if node["top"] is not None:
            tops.append((node["top"], children, leaves, saved))
            continue
        leaves = leaves if children else 1
        up = nodes.get(node["up"])
        if up is not None:
            up["n_children"] += 1
            up["n_leaves"] += leaves
            up["saved_tokens"] += saved
        parent = up["conv_id"] if up is not None else None
        done.append((key, node["conv_id"], node["depth"], parent, node["n_convs"], children, leaves, saved))
    return done, tops, [(key, node["conv_id"]) for key, node in nodes.items()]


def hash_ends(found: DataFrame) -> DataFrame:
    """``key, ends_sha256`` of the skeleton's nodes at which conversations end:
    one running hash over a node's parts in the order of shards."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        key, state = None, None
        for batch in batches:
            done = []
            for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        done.append((key, state.hexdigest()))
                    key, state = k, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _pairs(pa, done)
        if key is not None:
            yield _pairs(pa, [(key, state.hexdigest())])

    parts = found.where(F.col("kind") == ENDS).select("key", "shard", "part", "ids")
    parts = parts.repartition("key").sortWithinPartitions("key", "shard", "part")
    return parts.mapInArrow(run, "key string, ends_sha256 string")


def _pairs(pa, rows: list[tuple]):
    columns = [pa.array([r[i] for r in rows], pa.string()) for i in (0, 1)]
    return pa.RecordBatch.from_arrays(columns, names=["key", "ends_sha256"])


OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
BROADCAST_NODES = 100_000  # of the skeleton, 10 MB


def solve_level(level: DataFrame, block: int, shards: int | None) -> tuple[DataFrame, DataFrame | None]:
    """The nodes of one level, and its start nodes for the level above."""
    spark = level.sparkSession
    found = cut(scan_level(level, draw(level, shards), block))
    done, tops, members = skeleton(found)
    spine = spark.createDataFrame(done, "key string, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    parents = spark.createDataFrame(members, "up string, _parent long")
    if len(members) <= BROADCAST_NODES:
        parents = F.broadcast(parents)
    whole = found.where(F.col("kind") == FINISHED)
    settled = whole.where(F.col("up").isNull()).select(*OUT)
    hanging = whole.where(F.col("up").isNotNull()).drop("parent_conv_id").join(parents, "up", "left")
    hanging = hanging.withColumnRenamed("_parent", "parent_conv_id").select(*OUT)
    ended = spine.join(hash_ends(found), "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    columns = ["top", "n_children", "n_leaves", "saved_tokens"]
    above = found.where(F.col("kind") == TOP).select(*columns)
    above = above.unionByName(spark.createDataFrame(tops, "top string, n_children long, n_leaves long, saved_tokens long"))
    return settled.unionByName(hanging).unionByName(ended.select(*OUT)), above.toDF("top", "b_children", "b_leaves", "b_saved")


def lone_nodes(lone: DataFrame, block: int) -> DataFrame:
    """Nodes of blocks that no other conversation shares, row by row."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        types = [*[pa.int64()] * 7, pa.string()]
        for batch in batches:
            rows = []
            for conv, level, sizes, ends in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "level", "sizes", "ends")), strict=True):
                for i in range(len(sizes)):
                    last = ends and i == len(sizes) - 1
                    rows.append((conv, level * block + i + 1, conv, 1, 0 if last else 1, 1, 0, ends_hash([conv]) if last else NO_ENDS))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=OUT)

    return lone.select("conv_id", "level", "sizes", "ends").mapInArrow(run, NODE + ", ends_sha256 string")


def nodes(held: DataFrame, block: int = BLOCK, shards: int | None = None) -> DataFrame:
    """All nodes of the trie of ``blocks``."""
    held = cut(held)
    deepest = held.agg(F.max("level")).first()[0]
    if deepest is None:
        return held.sparkSession.createDataFrame([], NODE + ", ends_sha256 string")
    out, below, single = None, None, None
    if deepest:
        own = held.where(F.col("level") > 0)
        alone = own.groupBy("top").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 1).select("top")
        lone = cut(own.join(alone, "top", "left_semi"))
        out = lone_nodes(lone, block)
        any_child = (F.size("sizes") > 0).cast("long")
        below = single = lone.select("top", any_child.alias("b_children"), any_child.alias("b_leaves"), F.lit(0).cast("long").alias("b_saved"))
        shared = cut(held.join(alone, "top", "left_anti"))
        deepest = shared.agg(F.max("level")).first()[0]
    else:
        shared = held
    for level in range(deepest, -1, -1):
        rows = shared.where(F.col("level") == level)
        if below is None:
            rows = rows.select("*", *[F.lit(None).cast("long").alias(c) for c in ("b_children", "b_leaves", "b_saved")])
        else:
            rows = rows.join(below.withColumnRenamed("top", "after"), "after", "left")
        rows, above = solve_level(rows, block, shards)
        out = rows if out is None else out.unionByName(rows)
        if level:
            below = cut(above.unionByName(single.where(F.col("top").startswith(f"{level}."))))
    return out


def build(conversations: DataFrame, block: int = BLOCK, shards: int | None = None) -> DataFrame:
    """The trie of all rebuilt conversations, one row per node."""
    placed = cut(in_order(turns(conversations)))
    return nodes(blocks(*rebuilt(placed), block), block, shards)
