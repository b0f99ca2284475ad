"""The trie of all conversations, by a splitter skeleton over range-partitioned paths.

Every conversation is a path of turn digests. Paths are sorted by (path, conv_id) in as many ranges as
there are shuffle partitions. The paths of the splitters between the ranges form the skeleton, a
small trie that is broadcast. A node whose conversations lie in several ranges is a prefix of a
splitter, hence in the skeleton; all other nodes lie in one range, so the sorted shard finishes them
in one pass with a stack. For skeleton nodes each shard adds up what hangs directly below, these
parts are reduced by node, and one walk over the skeleton, children first, completes them. A first
turn, or a whole conversation, that very many share is thus cut into as many shards as it fills.

Turns are known by 128 bits of the SHA-256 of (role, text): two different ones in a trillion are
alike with odds of 2**-48 in all. Texts are read once and never moved. The list of conversations that
end at a node is hashed as a stream, in bounded memory, in one task a node, as the hash demands.

Bounds: one conversation is a row of about 50 bytes a turn. The skeleton has at most
``SKELETON_STEPS`` nodes, by taking fewer splitters where paths are long.

Defined results: rows with a NULL conv_id belong to no conversation; a NULL role or text is empty;
turns with one number follow each other by digest, a NULL turn first; repeated rows are turns of
their own; an empty table has no node, not even a root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pseudora.llm.store import dropped, shuffle_width, stored

GROUP = 100  # conversations of one base
MOST_LENT = 6  # the base lends fewer turns than this
SAMPLE = 32  # paths looked at for each splitter
SKELETON_STEPS = 250_000
_DIGITS = 32  # hexadecimal digits of a step
_IDS = 4096  # conversation ids in one piece of a list
_NO_ENDS = hashlib.sha256().hexdigest()

NODE, PART, ENDS = 0, 1, 2
PIECES = pa.schema(
    [("kind", pa.int32())]
    + [(name, pa.int64()) for name in ("skeleton", "shard", "chunk", "conv_id", "depth", "parent_conv_id")]
    + [(name, pa.int64()) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    + [("ends", pa.string())]
)
PIECES_SQL = ", ".join(f"{f.name} {({'int32': 'int', 'int64': 'long'}).get(str(f.type), 'string')}" for f in PIECES)
RESULT = (
    "conv_id",
    "depth",
    "parent_conv_id",
    "n_convs",
    "n_children",
    "n_leaves",
    "saved_tokens",
    "ends_sha256",
)


def conversation_paths(conversations: DataFrame) -> DataFrame:
    """(conv_id, steps): the digest and code points of every turn, in order."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit("")) for name in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            "turn",
            F.substring(F.sha2(said, 256), 1, _DIGITS).alias("step"),
            F.length(text).cast("long").alias("size"),
        ).alias("turn"),
    )
    listed = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    return listed.select("conv_id", F.transform("turns", lambda t: F.struct(t["step"].alias("step"), t["size"].alias("size"))).alias("steps"))


def rebuilt_paths(paths: DataFrame) -> DataFrame:
    """(conv_id, path, sizes) with the first turns of each conversation taken from its base."""
    lent = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_LENT).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    bases = paths.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("steps", 1, MOST_LENT - 1).alias("first")
    )
    both = paths.withColumns({"base": base, "lent": lent}).join(bases, "base", "left")
    none = F.slice("steps", 1, 0)
    first = F.slice(F.coalesce("first", none), F.lit(1), F.col("lent"))
    own = F.filter("steps", lambda _, k: k >= F.col("lent"))
    steps = F.concat(first, own)
    return both.select("conv_id", steps.alias("steps")).select(
        "conv_id", F.array_join("steps.step", "").alias("path"), F.col("steps.size").alias("sizes")
    )


def common_steps(a: str, b: str) -> int:
    """How many first steps two paths share."""
    if a == b:
        return len(a) // _DIGITS
    low, high = 0, min(len(a), len(b)) // _DIGITS
    while low < high:
        middle = (low + high + 1) // 2
        if a.startswith(b[: middle * _DIGITS]):
            low = middle
        else:
            high = middle - 1
    return low


@dataclass
class Skeleton:
    """The trie of the splitters' paths; node 0 is the root, parents come before their children."""

    keys: list[tuple[str, int]] = field(default_factory=list)
    #: Nodes on the path of each splitter, from the root.
    chains: list[list[int]] = field(default_factory=list)
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    size: list[int] = field(default_factory=lambda: [0])

    @classmethod
    def of(cls, splitters: list[tuple[str, int, list[int]]]) -> Skeleton:
        """From splitters in order."""
        self, last, chain = cls(), "", [0]
        for path, conv_id, sizes in splitters:
            chain = chain[: common_steps(last, path) + 1]
            for depth in range(len(chain), len(sizes) + 1):
                self.parent.append(chain[-1])
                self.depth.append(depth)
                self.size.append(sizes[depth - 1])
                chain.append(len(self.parent) - 1)
            self.keys.append((path, conv_id))
            self.chains.append(list(chain))
            last = path
        return self

    def known(self, shard: int, path: str) -> list[int]:
        """The nodes on a path of that shard that are in the skeleton, from the root."""
        found = [0]
        for near in (shard - 1, shard):
            if 0 <= near < len(self.keys):
                steps = common_steps(self.keys[near][0], path)
                if steps + 1 > len(found):
                    found = self.chains[near][: steps + 1]
        return found


def splitter_skeleton(rebuilt: DataFrame, shards: int, most_steps: int) -> Skeleton:
    """Splitters at even distances in a sample of paths drawn by hash, bounded in number and steps."""
    drawn = SAMPLE * shards
    while True:
        sample = rebuilt.orderBy(F.xxhash64("conv_id"), "conv_id").limit(drawn)
        steps = sample.agg(F.sum(F.size("sizes"))).first()[0] or 0
        if steps <= most_steps:
            break
        drawn //= 2
    rows = sorted((row.path, row.conv_id, list(row.sizes)) for row in sample.collect())
    places = sorted({k * len(rows) // shards for k in range(1, shards)}) if len(rows) > 1 else []
    return Skeleton.of([rows[k] for k in places if k])


def _deal(skeleton):
    """Adds to each path the number of its range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = skeleton.value.keys
        for batch in batches:
            rows = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            shards = pa.array([bisect_right(keys, row) for row in rows], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [shards, batch.column("path"), batch.column("conv_id"), batch.column("sizes")],
                names=["shard", "path", "conv_id", "sizes"],
            )

    return run


class _Node:
    """A node on the current path: what is known of the conversations and nodes below it so far."""

    __slots__ = ("conv_id", "n_convs", "n_children", "n_leaves", "saved", "size", "hash", "children")

    def __init__(self, size: int):
        self.size, self.conv_id, self.hash = size, None, None
        self.n_convs = self.n_children = self.n_leaves = self.saved = 0
        self.children: list[tuple] = []  # rows of finished children, which lack this node's conv_id

    def met(self, conv_id: int, n_convs: int = 1) -> None:
        self.n_convs += n_convs
        self.conv_id = conv_id if self.conv_id is None else min(self.conv_id, conv_id)

    def ended(self, conv_id: int) -> None:
        self.met(conv_id)
        text = str(conv_id).encode()
        if self.hash is None:
            self.hash = hashlib.sha256(text)
        else:
            self.hash.update(b"," + text)

    def adopted(self, child: _Node) -> None:
        self.met(child.conv_id, child.n_convs)
        self.n_children += 1
        self.n_leaves += child.n_leaves
        self.saved += child.saved

    def finished(self) -> None:
        self.saved += (self.n_convs - 1) * self.size
        self.n_leaves = self.n_leaves if self.n_children else 1


class ShardTrie:
    """One pass over the sorted paths of a shard; finished rows gather in ``out``."""

    def __init__(self, skeleton: Skeleton, shard: int):
        self.skeleton, self.shard, self.out = skeleton, shard, []
        self.path, self.known, self.stack = None, [0], []
        self.parts: dict[int, _Node] = {}
        self.ids: dict[int, list[str]] = {}
        self.chunks: dict[int, int] = {}

    def part(self, node: int) -> _Node:
        if node not in self.parts:
            self.parts[node] = _Node(0)
        return self.parts[node]

    def pop(self) -> None:
        node = self.stack.pop()
        node.finished()
        depth = len(self.known) + len(self.stack)
        ends = node.hash.hexdigest() if node.hash else _NO_ENDS
        row = (depth, node.conv_id, node.n_convs, node.n_children, node.n_leaves, node.saved, ends)
        for child in node.children:
            self.emit(*child, parent=node.conv_id)
        if self.stack:
            self.stack[-1].adopted(node)
            self.stack[-1].children.append(row)
        else:
            self.part(self.known[-1]).adopted(node)
            self.emit(*row, skeleton=self.known[-1])

    def emit(self, depth, conv_id, n_convs, n_children, n_leaves, saved, ends, *, parent=None, skeleton=None) -> None:
        self.out.append((NODE, skeleton, None, None, conv_id, depth, parent, n_convs, n_children, n_leaves, saved, ends))

    def add(self, path: str, conv_id: int, sizes: list[int]) -> None:
        if path != self.path:
            shared = 0 if self.path is None else common_steps(path, self.path)
            while self.stack and len(self.known) - 1 + len(self.stack) > shared:
                self.pop()
            if not self.stack:
                self.known = self.skeleton.known(self.shard, path)
            for depth in range(len(self.known) + len(self.stack), len(sizes) + 1):
                self.stack.append(_Node(sizes[depth - 1]))
            self.path = path
        if self.stack:
            self.stack[-1].ended(conv_id)
        else:
            node = self.known[-1]
            self.part(node).met(conv_id)
            self.ids.setdefault(node, []).append(str(conv_id))
            if len(self.ids[node]) >= _IDS:
                self.flush(node)

    def flush(self, node: int) -> None:
        chunk = self.chunks.get(node, 0)
        self.chunks[node] = chunk + 1
        self.out.append((ENDS, node, self.shard, chunk, *[None] * 7, ",".join(self.ids.pop(node))))

    def close(self) -> None:
        while self.stack:
            self.pop()
        for node in list(self.ids):
            self.flush(node)
        for node, part in self.parts.items():
            counts = (part.n_convs, part.n_children, part.n_leaves, part.saved)
            self.out.append((PART, node, self.shard, None, part.conv_id, None, None, *counts, None))


def _finish(skeleton):
    """Nodes of a shard that are no others', and its parts of the skeleton's nodes."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(zip(*rows, strict=True), PIECES.types, strict=True)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in columns], schema=PIECES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = None
        for batch in batches:
            columns = [batch.column(name).to_pylist() for name in ("shard", "path", "conv_id")]
            for shard, path, conv_id, sizes in zip(*columns, batch.column("sizes"), strict=True):
                if trie is None or shard != trie.shard:
                    if trie is not None:
                        trie.close()
                        if trie.out:
                            yield batch_of(trie.out)
                    trie = ShardTrie(skeleton.value, shard)
                trie.add(path, conv_id, sizes.as_py() if path != trie.path else [])
                if len(trie.out) >= 10_000:
                    yield batch_of(trie.out)
                    trie.out.clear()
        if trie is not None:
            trie.close()
            if trie.out:
                yield batch_of(trie.out)

    return run


def _hash_streams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of each node, whose pieces come in order."""
    node, stream = None, None
    names = ["skeleton", "ends_sha256"]
    for batch in batches:
        done = []
        for skeleton, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ends"), strict=True):
            if skeleton != node:
                if node is not None:
                    done.append((node, stream.hexdigest()))
                node, stream = skeleton, hashlib.sha256(ids.as_py().encode())
            else:
                stream.update(b"," + ids.as_py().encode())
        if done:
            yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*done, strict=True))), names=names)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([stream.hexdigest()])], names=names)


def _completed(skeleton: Skeleton, parts: dict[int, tuple]) -> list[tuple]:
    """Rows of the skeleton's nodes from their reduced parts, children first."""
    nodes = [_Node(size) for size in skeleton.size]
    for k in reversed(range(len(nodes))):
        node = nodes[k]
        if k in parts:
            conv_id, n_convs, n_children, n_leaves, saved = parts[k]
            node.met(conv_id, n_convs)
            node.n_children += n_children
            node.n_leaves += n_leaves
            node.saved += saved
        if not node.n_convs:
            return []  # no conversations at all
        node.finished()
        if k:
            nodes[skeleton.parent[k]].adopted(node)
    return [
        (k, n.conv_id, skeleton.depth[k], nodes[skeleton.parent[k]].conv_id if k else None, n.n_convs, n.n_children, n.n_leaves, n.saved)
        for k, n in enumerate(nodes)
    ]


def prefix_trie(conversations: DataFrame, *, shards: int | None = None, most_steps: int = SKELETON_STEPS) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations."""
    session = conversations.sparkSession
    shards = shards or shuffle_width(session)
    paths = stored(conversation_paths(conversations), "paths")
    rebuilt = stored(rebuilt_paths(paths), "rebuilt")
    dropped(paths)
    skeleton = splitter_skeleton(rebuilt, shards, most_steps)
    shared = session.sparkContext.broadcast(skeleton)
    dealt = rebuilt.mapInArrow(_deal(shared), "shard int, path string, conv_id long, sizes array<long>")
    sorted_shards = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    pieces = stored(sorted_shards.mapInArrow(_finish(shared), PIECES_SQL), "pieces")
    dropped(rebuilt)
    shared.destroy()

    sums = [F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    parts = pieces.where(F.col("kind") == PART).groupBy("skeleton").agg(F.min("conv_id").alias("conv_id"), *sums)
    reduced = {row[0]: tuple(row)[1:] for row in parts.collect()}  # at most a row per skeleton node
    names = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    top = session.createDataFrame(_completed(skeleton, reduced), f"skeleton long, {names}")

    lists = pieces.where(F.col("kind") == ENDS).repartition(shuffle_width(session), "skeleton")
    lists = lists.sortWithinPartitions("skeleton", "shard", "chunk").select("skeleton", "ends")
    hashed = lists.mapInArrow(_hash_streams, "skeleton long, ends_sha256 string")
    top_rows = top.join(hashed, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS)))
    nodes = pieces.where(F.col("kind") == NODE).withColumnRenamed("ends", "ends_sha256")
    # The skeleton is bounded by ``most_steps``, hence the hint.
    above = F.broadcast(top.select("skeleton", F.col("conv_id").alias("_above")))
    nodes = nodes.join(above, "skeleton", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_above"))
    return nodes.select(*RESULT).unionByName(top_rows.select(*RESULT))


#: The same trie by grouping all prefixes; the lent number of turns is a CRC-32, bit by bit.
ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, list([coalesce(role, ''), coalesce(text, '')]
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), lent AS (
  SELECT *, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(
    list_concat([4294967295], flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
      lambda c: [CAST(ord(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
    lambda crc, x: CASE WHEN x >= 0 THEN xor(crc, x)
      ELSE xor(crc >> 1, 3988292384 * (crc & 1)) END)) % 6 AS h
  FROM turns
), rebuilt AS (
  SELECT l.conv_id, list_concat(coalesce(b.own, [])[1 : l.h], l.own[l.h + 1 :]) AS path
  FROM lent l LEFT JOIN turns b ON b.conv_id = l.base
), member AS (
  SELECT conv_id, path, d, path[1 : d] AS node FROM rebuilt, LATERAL (SELECT unnest(range(0, len(path) + 1)) AS d)
), node AS (
  SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs,
    CASE WHEN d = 0 THEN 0 ELSE (count(*) - 1) * length(node[d][2]) END AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = d), '')) AS ends
  FROM member GROUP BY node, d
), child AS (
  SELECT node[1 : d - 1] AS above, count(*) AS n_children FROM node WHERE d > 0 GROUP BY above
), below AS (
  SELECT n.node[1 : k] AS top, sum(n.saved) AS saved, count(*) FILTER (c.above IS NULL) AS leaves
  FROM node n LEFT JOIN child c ON c.above = n.node, LATERAL (SELECT unnest(range(0, n.d + 1)) AS k)
  GROUP BY top
)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs,
  coalesce(c.n_children, 0) AS n_children, b.leaves AS n_leaves,
  CAST(b.saved AS BIGINT) AS saved_tokens, n.ends AS ends_sha256
FROM node n JOIN below b ON b.top = n.node LEFT JOIN child c ON c.above = n.node
LEFT JOIN node p ON n.d > 0 AND p.node = n.node[1 : n.d - 1]
"""
