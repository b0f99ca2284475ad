"""Exact top-k search by inner product with a pivot table and exact stopping.

One more coordinate makes all stored vectors equally long, so that the largest inner product is the
smallest distance. Distances to the pivots, computed once per vector and stored beside it, bound
every distance from below by the largest |d(query, pivot) - d(vector, pivot)|. A query takes
candidates in bound order and stops as soon as the next bound exceeds its k-th distance; ties at it are still
looked at, so results are exact. Scores are integers: products that a double holds exactly are taken
in doubles, larger ones in 64-bit or, beyond these, Python's integers, where bounds on rounded
distances prove nothing and every candidate is looked at.

Queries meet the vectors in blocks: query block x vector block is one group of bounded size that
yields k rows per query; a window keeps the best k. Pivots are ``PIVOTS`` rows, chosen by hash
order among distinct vectors; they only steer the pruning.

Defined results: vectors that are NULL, empty, or hold a NULL or non-finite component take no part;
vectors of another length than a query are no candidates of it; a query with fewer candidates gets
all; rows with a query's own id are never its candidates; repeated rows are candidates each for
itself; rows that share a query id ask once, with the smallest of their vectors; scores beyond the
range of a long are its ends, and components beyond it too; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from pseudora.llm.store import dropped, stored

TOP = 20
PIVOTS = 16
SCALE = 64
QUERY_BLOCK, VECTOR_BLOCK = 1024, 16_384
_STEP = 512
_FEW = 8  # less than this part of a block is taken out of it


def quantized(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * x) of every component as a double, NULL unless all are finite."""
    wide = F.transform(embedding, lambda x: x.cast("double"))
    limit = F.lit(float("inf"))
    odd = F.exists(wide, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == limit))
    return F.when(
        (F.size(embedding) > 0) & ~odd, F.transform(wide, lambda x: F.floor(x * scale))
    )


def choose_pivots(vectors: DataFrame, count: int = PIVOTS) -> list[list[int]]:
    """At most ``count`` distinct vectors, the first in hash order."""
    rows = vectors.select("v").distinct().orderBy(F.xxhash64("v"), "v").limit(count).collect()
    return [list(row["v"]) for row in rows]


def _distances(pivots: list[list[int]], longest: float):
    """Distance of each vector, filled up to norm ``longest`` by one more coordinate, to the pivots of its length.

    The added coordinate is 0 for pivots and queries.
    """

    def measure(vectors: pd.Series) -> pd.Series:
        result = [np.empty(0, dtype=np.float32)] * len(vectors)
        sizes = vectors.map(len).to_numpy()
        for size in np.unique(sizes):
            anchors = np.asarray([p for p in pivots if len(p) == size], dtype=np.float64)
            if len(anchors):
                rows = np.flatnonzero(sizes == size)
                own = np.stack(vectors.to_numpy()[rows]).astype(np.float64)
                squares = longest + (anchors**2).sum(axis=1) - 2 * own @ anchors.T
                for row, far in zip(rows, np.sqrt(np.maximum(squares, 0)).astype(np.float32), strict=True):
                    result[row] = far
        return pd.Series(result)

    return F.pandas_udf(measure, "array<float>")


def _exact_type(vectors: np.ndarray, queries: np.ndarray) -> type:
    """The narrowest type that holds every product and its partial sums exactly."""
    largest = float(np.abs(vectors.astype(np.float64)).max()) * float(np.abs(queries.astype(np.float64)).max())
    largest *= vectors.shape[1] * (1 + 1e-9)
    if largest < 2.0**24:
        return np.float32
    return np.float64 if largest < 2.0**53 else np.int64 if largest < 2.0**63 else object


def _as_long(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        scores = np.array([min(max(s, -(2**63)), 2**63 - 1) for s in scores], dtype=np.int64)
    return scores.astype(np.int64)


def _block_search(pivots: list[list[int]], longest: float, top: int):
    def search(group: pd.DataFrame) -> pd.DataFrame:
        result = {"query_id": [], "vec_id": [], "score": []}
        sides = group["side"].to_numpy()
        sizes = group["v"].map(len).to_numpy()
        for size in np.unique(sizes):
            same = group[sizes == size]
            kind = sides[sizes == size]
            q, x = same[kind == 0], same[kind == 1]
            x = x.loc[x.index.repeat(x["copies"])]
            if len(q) and len(x):
                _search(q, x, [p for p in pivots if len(p) == size], longest, top, result)
        return pd.DataFrame(
            {
                name: np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)
                for name, parts in result.items()
            }
        )

    return search


def _search(q: pd.DataFrame, x: pd.DataFrame, pivots, longest: float, top: int, result: dict) -> None:
    ids = x["vec_id"].to_numpy(dtype=np.int64)
    by_id = np.argsort(ids, kind="stable")
    ids = ids[by_id]
    vectors, queries = np.stack(x["v"].to_numpy())[by_id], np.stack(q["v"].to_numpy())
    query_ids = q["vec_id"].to_numpy(dtype=np.int64)
    exact = _exact_type(vectors, queries)
    if exact not in (np.float32, np.float64) or not pivots:
        vectors, queries = vectors.astype(exact), queries.astype(exact)
        open_end = np.full(len(ids), np.inf)
        for k in range(len(q)):
            _keep(result, query_ids[k], *_in_bound_order(ids, vectors, queries[k], open_end, query_ids[k], top))
        return
    vectors, scored_queries, queries = vectors.astype(exact), queries.astype(exact), queries.astype(np.float64)
    query_norms = (queries**2).sum(axis=1)
    anchors = np.asarray(pivots, dtype=np.float64)
    to_queries = np.sqrt(np.maximum(query_norms[:, None] + (anchors**2).sum(axis=1) - 2 * queries @ anchors.T, 0))
    to_vectors = np.ascontiguousarray(np.stack(x["far"].to_numpy())[by_id].astype(np.float32).T)
    slack = 1e-3 + 1e-6 * (float(to_queries.max()) + float(to_vectors.max()))
    for k in range(len(q)):
        bound = np.zeros(len(ids), dtype=np.float32)
        for near, far in zip(to_queries[k].astype(np.float32), to_vectors, strict=True):
            np.maximum(bound, np.abs(far - near), out=bound)
        # A bound on the distance is one on the score; a little slack covers rounding.
        most = longest + query_norms[k]
        ceiling = (most * (1 + 1e-12) - (bound.astype(np.float64) - slack).clip(0) ** 2) / 2
        _keep(result, query_ids[k], *_in_bound_order(ids, vectors, scored_queries[k], ceiling, query_ids[k], top))


def _keep(result: dict, query_id: int, best_ids: np.ndarray, best: np.ndarray) -> None:
    result["query_id"].append(np.full(len(best), query_id))
    result["vec_id"].append(best_ids)
    result["score"].append(best)


def _in_bound_order(ids, vectors, query, ceiling, own_id, top):
    """The best ``top`` of one block, looked at from the highest ceiling down."""
    best_ids, best = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    step = _STEP
    rest = np.arange(len(ids))
    while len(rest):
        if step < len(rest):
            split = np.argpartition(-ceiling[rest], step)
            chosen, rest = rest[split[:step]], rest[split[step:]]
        else:
            chosen, rest = rest, rest[:0]
        # Most of a block is scored where it lies; few rows are taken out of it.
        scores = (vectors @ query)[chosen] if _FEW * len(chosen) > len(ids) else vectors[chosen] @ query
        scores = _as_long(scores)
        other = ids[chosen] != own_id
        if len(best) == top:
            other &= scores >= best[-1]
        best_ids, best = np.concatenate([best_ids, ids[chosen[other]]]), np.concatenate([best, scores[other]])
        order = np.lexsort((best_ids, ~best))[:top]  # ~ reverses the order of all longs
        best_ids, best = best_ids[order], best[order]
        if len(best) == top:
            rest = rest[ceiling[rest] >= best[-1]]
        # The first look sets the bar; if much is left above it, one product takes all of it.
        step = len(rest) if _FEW * len(rest) > len(ids) else step * 4
    return best_ids, best


def top_k(
    rows: DataFrame,
    is_query: Column,
    *,
    top: int = TOP,
    scale: int = SCALE,
    query_block: int = QUERY_BLOCK,
    vector_block: int = VECTOR_BLOCK,
    pivots: int = PIVOTS,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of rows (vec_id, embedding)."""
    vectors = rows.select("vec_id", quantized(F.col("embedding"), scale).alias("v"))
    vectors = vectors.where(F.col("v").isNotNull() & F.col("vec_id").isNotNull())
    # Of rows that repeat, no more than ``top`` can be among the best: one row and its copies.
    vectors = vectors.groupBy("vec_id", "v").agg(F.least(F.count(F.lit(1)), F.lit(top)).alias("copies"))
    vectors = stored(vectors, "vectors")
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    counts = vectors.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q"), F.max(norm).alias("longest")
    ).first()
    longest = counts["longest"] or 0.0
    wide, high = -(-counts["n"] // vector_block) or 1, -(-counts["q"] // query_block) or 1
    anchors = choose_pivots(vectors, pivots)
    # The pivot table: every cell that a vector comes to reads its distances.
    table = stored(vectors.withColumn("far", _distances(anchors, longest)("v")), "pivot-table")
    dropped(vectors)

    def block(salt: int, blocks: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(salt), "vec_id", "v"), F.lit(blocks)).cast("int")

    def every(blocks: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    asked = table.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"), F.lit(1).cast("long").alias("copies"))
    asked = asked.withColumn("far", F.lit(None).cast("array<float>"))
    queries = asked.withColumns({"row": block(1, high), "side": F.lit(0)})
    queries = queries.withColumn("column", every(wide))
    others = table.withColumns({"column": block(2, wide), "side": F.lit(1)})
    others = others.withColumn("row", every(high))
    cells = queries.unionByName(others).groupBy("row", "column")
    found = cells.applyInPandas(_block_search(anchors, longest, top), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
    vec_id, score FROM p) WHERE rank <= 20
"""
