"""Jaccard join of word n-gram sets through count vectors in an R-tree.

Links are pairs of sets with 100 * |A & B| >= percent * |A | B|.

1. Equal sets are one class (size and 128-bit fingerprint); classes are joined, not copies.
2. Tiles. Linked sets whose sizes lie in the same or the next size band differ in at most D
   n-grams. Hash space is cut into D + 2 groups, so two linked sets agree in at least two groups
   entirely; each set emits one key per group it has n-grams in (and, if more than one of its
   groups is empty, keys for those too), so linked sets always share a key. A shared passage does
   not make a shared key: whole groups must agree.
3. Sets that share keys, directly or through others, form a block, nearly always a small one: one
   cell. In a large one, such as a family of texts from one template, each set is first verified
   against the smallest set it shares a key with, in star cells that hold that one and a bounded
   number of others. Sets linked so are one part; a block that is one part is done, each set having
   moved once. Otherwise blocks are cut by part, size band and hash into leaves, and leaf pairs into
   cells of bounded size; leaves of the same part never meet.
4. In a cell, n-grams are hashed into ``GROUPS`` groups and the counts indexed as points in an
   R-tree. The overlap of two boxes is at most the sum over groups of the smaller upper bound;
   pairs of boxes, then of points, that cannot reach the needed overlap are pruned, and the rest
   are verified on the full sets. Pairs already in one component are not verified again. An n-gram
   is its 64-bit hash: among sets of 10^5 n-grams two different ones agree with odds of about 10^-9.
5. Cells yield spanning links, whose connected components are the result. No pair is lost, none
   emitted but spanning links.

Defined results: a text without words, or NULL, has no n-grams and is linked with nothing; rows
that share a doc_id are one document, linked by any of their texts; a row with a NULL doc_id gets
the component of its class, NULL if that has no id; an empty table gives no rows; other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm import textvec
from pseudora.llm.components import connected
from pseudora.llm.packing import ROW, packed, unpacked, without
from pseudora.llm.store import dropped, stored

SIZE, PERCENT = 3, 90
GROUPS, NODE = 64, 24
CELL_DOCS, CELL_GRAMS = 768, 1_000_000
BROADCAST_MEMBERS = 500_000
BATCH_ROWS = 256
_U = np.uint64
_HALF = _U(32)


def size_bands(percent: int) -> list[tuple[int, int]]:
    """Ranges of sizes such that linked sets lie in the same or in neighbouring ranges."""
    bands, low = [], 1
    while low < 1 << 31:
        high = max(low, 100 * low // percent)
        bands.append((low, high))
        low = high + 1
    return bands


def sets_of(texts: list[bytes], size: int) -> Iterator[np.ndarray]:
    """The sorted distinct n-gram hashes of each text."""
    for first, last in textvec.sub_batches(texts):
        words = textvec.Words(texts[first:last])
        hashes = words.hashes()
        for a, b in zip(words.first, words.last, strict=True):
            yield np.unique(textvec.shingle_hashes(hashes[a:b], size))


def fingerprint(grams: np.ndarray) -> tuple[int, int]:
    spread = textvec.mixed(grams)
    other = textvec.mixed(spread ^ _U(0x5851F42D4C957F2D))
    return spread.sum(dtype=np.uint64).astype(np.int64), other.sum(dtype=np.uint64).astype(np.int64)


class TileKeys:
    """Keys of a set: one for every group of hash space, for the set's size band and the next."""

    def __init__(self, percent: int):
        self.bands = size_bands(percent)
        self.tops = np.array([high for _, high in self.bands])
        self.differ = [2 * high * (100 - percent) // (100 + percent) for _, high in self.bands]
        self.salts: dict[int, np.ndarray] = {}

    def of(self, grams: np.ndarray) -> np.ndarray:
        if not len(grams):
            return np.empty(0, dtype=np.int64)
        band = int(np.searchsorted(self.tops, len(grams)))
        spread, upper, keys = textvec.mixed(grams), grams >> _HALF, []
        for tag in (band, band + 1):
            if not self.differ[tag]:
                continue  # such sets can only be equal
            groups = self.differ[tag] + 2
            salt = self.salts.get(tag)
            if salt is None:
                ids = np.arange(groups, dtype=np.uint64) | _U(tag + 1) << _HALF
                salt = self.salts[tag] = textvec.mixed(ids)
            # Hashes are sorted, so the groups are neighbouring ranges.
            starts = np.searchsorted((upper * _U(groups)) >> _HALF, np.arange(groups, dtype=np.uint64))
            filled = np.diff(starts, append=len(grams)) > 0
            sums = np.zeros(groups, dtype=np.uint64)
            sums[filled] = np.add.reduceat(spread, starts[filled])
            tile = textvec.mixed(sums ^ salt)
            keys.append(tile if (~filled).sum() > 1 else tile[filled])
        return np.concatenate(keys).view(np.int64) if keys else np.empty(0, dtype=np.int64)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, few at a time, so that texts and keys of few rows are in Python's memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(at, BATCH_ROWS)


def _describe(size: int, percent: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("f1", pa.int64()), ("f2", pa.int64()), ("keys", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = TileKeys(percent)
        for batch in _short(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            counts, prints, keys = [], [], []
            for grams in sets_of(texts, size):
                counts.append(len(grams))
                prints.append(fingerprint(grams))
                keys.append(tiles.of(grams))
            ends = np.cumsum([0, *map(len, keys)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(ends, np.concatenate([np.empty(0, dtype=np.int64), *keys]))
            f = np.array(prints, dtype=np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(f[:, 0]), pa.array(f[:, 1]), lists], schema=schema
            )

    return run


def _set_rows(size: int):
    schema = pa.schema([("doc_id", pa.int64()), ("f1", pa.int64()), ("grams", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _short(batches):
            texts = [t or b"" for t in batch.column("text").cast(pa.binary()).to_pylist()]
            wanted = zip(batch.column("f1").to_pylist(), batch.column("f2").to_pylist(), strict=True)
            ids = batch.column("doc_id").to_pylist()
            for doc_id, grams, prints in zip(ids, sets_of(texts, size), wanted, strict=True):
                if tuple(map(int, fingerprint(grams))) == prints:
                    lists = pa.array([grams.view(np.int64)], pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([doc_id], pa.int64()), pa.array([prints[0]], pa.int64()), lists], schema=schema
                    )

    return run


class _Tree:
    """Bulk-loaded R-tree: split at the median of the widest coordinate down to ``NODE`` points."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, rows: np.ndarray):
        self.rows = rows
        own = points[rows]
        self.high = own.max(axis=0)
        self.least, self.most = sizes[rows].min(), sizes[rows].max()
        self.parts: tuple[_Tree, _Tree] | None = None
        if len(rows) > NODE:
            widest = int(np.argmax(self.high - own.min(axis=0)))
            order = rows[np.argsort(own[:, widest], kind="stable")]
            half = len(order) // 2
            self.parts = _Tree(points, sizes, order[:half]), _Tree(points, sizes, order[half:])


class CellJoin:
    """All links of one cell up to connectivity."""

    def __init__(self, grams: list[np.ndarray], leaves: np.ndarray, parts: np.ndarray, percent: int):
        self.grams, self.leaves, self.percent = grams, leaves, percent
        self.sizes = np.array([len(g) for g in grams], dtype=np.int64)
        self.points = np.stack(
            [np.bincount(((g >> _HALF) * _U(GROUPS) >> _HALF).astype(np.int64), minlength=GROUPS) for g in grams]
        ).astype(np.int32)
        # Sets of one part are in one component from the start.
        _, first, part = np.unique(parts, return_index=True, return_inverse=True)
        self.parent = first[part.ravel()].tolist()
        self.links: list[tuple[int, int]] = []

    def root(self, k: int) -> int:
        while self.parent[k] != k:
            self.parent[k] = self.parent[self.parent[k]]
            k = self.parent[k]
        return k

    def run(self) -> list[tuple[int, int]]:
        sides = [
            _Tree(self.points, self.sizes, np.flatnonzero(self.leaves == leaf)) for leaf in np.unique(self.leaves)
        ]
        work = [(sides[0], sides[-1])]  # one side: the tree with itself
        while work:
            a, b = work.pop()
            if a is not b and not self.may_link(a, b):
                continue
            if a.parts is None and b.parts is None:
                self.join_points(a.rows, b.rows, a is b)
            elif a is b:
                left, right = a.parts
                work += [(left, right), (left, left), (right, right)]
            elif b.parts is None or (a.parts is not None and len(a.rows) >= len(b.rows)):
                work += [(part, b) for part in a.parts]
            else:
                work += [(a, part) for part in b.parts]
        return self.links

    def may_link(self, a: _Tree, b: _Tree) -> bool:
        p = self.percent
        if 100 * a.most < p * b.least or 100 * b.most < p * a.least:
            return False
        bound = int(np.minimum(a.high, b.high).sum())
        return (100 + p) * bound >= p * int(a.least + b.least)

    def join_points(self, rows: np.ndarray, others: np.ndarray, same: bool) -> None:
        p = self.percent
        bound = np.minimum(self.points[rows][:, None, :], self.points[others][None, :, :]).sum(axis=2)
        possible = (100 + p) * bound >= p * (self.sizes[rows][:, None] + self.sizes[others][None, :])
        if same:
            possible = np.triu(possible, 1)
        for i, j in zip(*np.nonzero(possible), strict=True):
            i, j = int(rows[i]), int(others[j])
            a, b = self.root(i), self.root(j)
            if a != b and self.linked(self.grams[i], self.grams[j]):
                self.parent[a] = b
                self.links.append((i, j))

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        both = np.sort(np.concatenate([a, b]))
        common = int((both[1:] == both[:-1]).sum())
        return 100 * common >= self.percent * (len(a) + len(b) - common)


def _join_cell(percent: int):
    def run(cell: pd.DataFrame) -> pd.DataFrame:
        ids = cell["doc_id"].to_numpy(dtype=np.int64)
        grams = [np.asarray(g, dtype=np.int64).view(np.uint64) for g in cell["grams"]]
        leaves, parts = cell["leaf"].to_numpy(), cell["part"].to_numpy()
        links = CellJoin(grams, leaves, parts, percent).run() if len(ids) > 1 else []
        at = np.array(links, dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"u": ids[at[:, 0]], "v": ids[at[:, 1]]})

    return run


def _pieces(cell_docs: int, cell_grams: int) -> Column:
    """Pieces of which any two fit in a cell, for an aggregate over members."""
    return F.ceil(F.greatest(F.count(F.lit(1)) * 2 / cell_docs, F.sum("n") * 2 / cell_grams)).cast("int")


def _star_cells(members: DataFrame, near: DataFrame, cell_docs: int, cell_grams: int) -> DataFrame:
    """(doc_id, f1, part, cell, leaf): each member with the smallest set that it shares a key with."""
    hubs = near.groupBy(F.col("u").alias("doc_id")).agg(F.min("v").alias("hub"))
    spokes = members.join(hubs, "doc_id")
    chunks = spokes.groupBy("hub").agg(_pieces(cell_docs, cell_grams).alias("chunks"))
    several = chunks.where("chunks > 1")  # no more of them than members by the half of a cell
    chunk = F.pmod(F.xxhash64("doc_id"), F.coalesce("chunks", F.lit(1))).cast("int")
    met = spokes.join(several, "hub", "left").withColumn("chunk", chunk)
    outer = met.select("doc_id", "f1", F.concat_ws(":", F.lit("star"), "hub", "chunk").alias("cell"), F.lit(1).alias("leaf"))
    middle = chunks.join(members.select(F.col("doc_id").alias("hub"), "f1"), "hub")
    middle = middle.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    middle = middle.select(
        F.col("hub").alias("doc_id"), "f1", F.concat_ws(":", F.lit("star"), "hub", "chunk").alias("cell"), F.lit(0).alias("leaf")
    )
    return outer.union(middle).withColumn("part", F.col("doc_id"))


def _cut_cells(members: DataFrame, percent: int, cell_docs: int, cell_grams: int) -> DataFrame:
    """(doc_id, f1, part, cell, leaf): every two members of a block, but of one large part, meet in one cell."""
    # Sizes in the same or a neighbouring band; the factor makes up for rounding.
    ratio = float(np.log(100 / percent) * (1 + 1e-9))
    sized = members.withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(ratio)).cast("long"))
    # Parts that fill leaves have their own; those below share leaves, tagged by no id.
    parts = sized.groupBy("block", "part").agg(_pieces(cell_docs, cell_grams).alias("pieces"))
    parts = parts.where("pieces > 1").select("block", "part", F.col("part").alias("tag"))
    sized = sized.join(parts, ["block", "part"], "left").withColumn("tag", F.coalesce(F.col("tag").cast("string"), F.lit("")))
    leaves = sized.groupBy("block", "band", "tag").agg(_pieces(cell_docs, cell_grams).alias("leaves"))
    own = sized.join(leaves, ["block", "band", "tag"]).withColumn(
        "mine", F.pmod(F.xxhash64("doc_id"), F.col("leaves")).cast("int")
    )
    near = F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1))
    others = leaves.select(
        "block", F.col("band").alias("other"), F.col("tag").alias("other_tag"), F.col("leaves").alias("other_leaves")
    )
    met = own.withColumn("other", near).join(others, ["block", "other"])
    met = met.where((F.col("tag") == "") | (F.col("tag") != F.col("other_tag")))
    met = met.withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col("other_leaves") - 1)))
    here = F.struct(F.col("band").alias("b"), F.col("tag").alias("t"), F.col("mine").alias("l"))
    there = F.struct(F.col("other").alias("b"), F.col("other_tag").alias("t"), F.col("theirs").alias("l"))
    first, last = F.least(here, there), F.greatest(here, there)
    cell = F.concat_ws(":", "block", *(end[field] for end in (first, last) for field in "btl"))
    return met.select("doc_id", "f1", cell.alias("cell"), F.when(here == first, 0).otherwise(1).alias("leaf"), "part")


def _sets_of_members(docs: DataFrame, members: DataFrame, size: int) -> DataFrame:
    """The full sets of block members, read again from their texts."""
    wanted = members.select("doc_id", "f1", "f2")
    if members.count() <= BROADCAST_MEMBERS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id")
    rows = texts.mapInArrow(_set_rows(size), "doc_id long, f1 long, grams array<long>")
    return rows.dropDuplicates(["doc_id", "f1"])


def jaccard_components(
    docs: DataFrame,
    *,
    size: int = SIZE,
    percent: int = PERCENT,
    cell_docs: int = CELL_DOCS,
    cell_grams: int = CELL_GRAMS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of ``docs`` (doc_id, text)."""
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = stored(
        plain.mapInArrow(_describe(size, percent), "doc_id long, n long, f1 long, f2 long, keys array<long>"),
        "sets",
    )
    same = ["n", "f1", "f2"]
    ids = described.where("n > 0 AND doc_id IS NOT NULL")
    classes = stored(ids.groupBy(*same).agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys")), "classes")

    # Members of a tile are linked to its first one. Keys of one class alone, nearly all, stay behind.
    shared = classes.select("rep", F.explode("keys").alias("key"))
    firsts = shared.groupBy("key").agg(F.min("rep").alias("v"), F.max("rep").alias("last"))
    firsts = firsts.where("v < last").select("key", "v")
    near = shared.join(firsts, "key").where("v < rep").select(F.col("rep").alias("u"), "v").distinct()
    near = stored(near, "near")
    blocks = connected(near)
    members = blocks.select(F.col("node").alias("doc_id"), F.col("component").alias("block")).join(
        classes.select(F.col("rep").alias("doc_id"), *same), "doc_id"
    )
    members = stored(members.withColumn("part", F.col("doc_id")), "members")

    def joined(cells: DataFrame, held: DataFrame) -> DataFrame:
        met = cells.join(_sets_of_members(plain, held, size), ["doc_id", "f1"])
        return met.groupBy("cell").applyInPandas(_join_cell(percent), "u long, v long")

    large = members.groupBy("block").agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("grams"))
    large = stored(large.where((F.col("docs") > cell_docs) | (F.col("grams") > cell_grams)).select("block"), "large")
    open_members = members.join(large, "block", "left_anti")
    cells = open_members.select("doc_id", "f1", F.col("block").cast("string").alias("cell"), F.lit(0).alias("leaf"), "part")
    stars = None
    if large.limit(1).count():
        cut = stored(members.join(large, "block", "left_semi"), "cut")
        stars = stored(joined(_star_cells(cut, near, cell_docs, cell_grams), cut), "stars")
        parts = connected(stars).select(F.col("node").alias("doc_id"), F.col("component").alias("above"))
        cut = cut.join(parts, "doc_id", "left").withColumn("part", F.coalesce("above", "doc_id")).drop("above")
        cut = stored(cut, "parts")
        several = cut.groupBy("block").agg(F.min("part").alias("least"), F.max("part").alias("most")).where("least < most")
        rest = stored(cut.join(several.select("block"), "block", "left_semi"), "rest")
        cells = cells.unionByName(_cut_cells(rest, percent, cell_docs, cell_grams))
        open_members = open_members.unionByName(rest)
    links = joined(cells, open_members)
    if stars is not None:
        links = links.union(stars)

    rows = described.select("doc_id", *same).join(classes.select(*same, "rep"), same, "left")
    rows = stored(rows, "rows")
    # An id with several texts joins their classes.
    several = rows.where("rep IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id")
    several = several.agg(F.min("rep").alias("v"), F.max("rep").alias("most")).where("v < most").drop("most")
    through = rows.join(several, "doc_id").select(F.col("rep").alias("u"), "v").where("u <> v")
    found = connected(links.union(through))
    for table in (described, classes, members):
        dropped(table)
    component = F.coalesce("component", "rep", "doc_id")
    return rows.join(found, rows["rep"] == found["node"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")
    )


def keep_one(docs: DataFrame, **parameters) -> DataFrame:
    """Keep one row of each component, that with the smallest id, rows with NULL ids last.

    Components are those of rows, numbered in a stored copy: ids may be NULL, repeated or have
    unrelated texts. Rows without words are linked with nothing, so all of them stay. Texts are not
    shuffled so long as the numbers of the rows that go are few enough to be broadcast.
    """
    rows = stored(packed(docs).withColumn("number", F.monotonically_increasing_id()), "rows-in")
    texts = rows.select(F.col("number").alias("doc_id"), F.col(ROW)["text"].alias("text"))
    found = jaccard_components(texts, **parameters)
    found = found.select(F.col("doc_id").alias("number"), "component_id")
    ids = rows.select("number", F.col(ROW)["doc_id"].alias("doc_id")).join(found, "number")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "number")).alias("first")
    kept = ids.groupBy("component_id").agg(first, F.count(F.lit(1)).alias("members"))
    # Only rows of components with others go.
    several = kept.where("members > 1").select("component_id", F.col("first.number").alias("kept"))
    gone = ids.join(several, "component_id").where("number <> kept").select("number")
    return unpacked(without(rows, gone, "number"), docs.columns)


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(w[p:p + least(3, len(w)) - 1], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS p FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
i AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (
  SELECT a, b FROM i JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * i >= 90 * (x.n + y.n - i)),
r AS (SELECT a AS doc_id, b AS other FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.other = e.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(w.doc_id, min(r.other))::BIGINT AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY w.doc_id, n.n
"""
