from __future__ import annotations

import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pseudora.llm import topk

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, score string"


def brute_force(rows, top=20):
    """Score every candidate of every query."""
    whole = [
        (i, tuple(math.floor(64 * x) for x in v))
        for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    found = []
    for q in sorted({i for i, _ in whole if i % 20 == 0}):
        query = min(v for i, v in whole if i == q)
        scored = [
            (-sum(a * b for a, b in zip(query, v, strict=True)), i) for i, v in whole if i != q and len(v) == len(query)
        ]
        found += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top])]
    return found


def make(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, "s") for i, v in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("blocks", [(1024, 16384), (2, 40)])
def test_neighbours_equal_brute_force(spark, blocks):
    chance = random.Random(1)
    # Halves and quarters are exact in every float type and make many ties.
    rows = [(k, [chance.randint(-8, 8) / 4 for _ in range(6)]) for k in range(300)]
    rows += [(400 + k, [0.25] * 6) for k in range(60)] + [(20, rows[20][1]), (401, [0.25] * 6)]
    rows += [(500, None), (501, []), (502, [1.0, None]), (503, [float("nan")] * 6), (504, [float("inf")] * 6), (None, [1.0] * 6)]
    rows += [(520, [1.0, 2.0]), (521, [0.5, 0.5]), (540, [3.0, 3.0, 3.0])]
    found = topk.top_k(make(spark, rows), F.col("vec_id") % 20 == 0, query_block=blocks[0], vector_block=blocks[1])
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.collect())
    assert got == brute_force(rows)


def test_clustered_vectors_are_pruned_without_loss(spark):
    chance = random.Random(2)
    centers = [[chance.gauss(0, 1) for _ in range(16)] for _ in range(5)]
    rows = [(k, [c + chance.gauss(0, 0.05) for c in centers[k % 5]]) for k in range(1500)]
    rows = [(i, [float(f"{x:.3f}") for x in v]) for i, v in rows]
    df = make(spark, rows)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, vector_block=400).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_force(exact)


def test_no_rows(spark):
    assert topk.top_k(make(spark, []), F.col("vec_id") % 20 == 0).count() == 0


@pytest.mark.parametrize("size", [1e6, 1e7, 2e7])
def test_large_components_are_exact(spark, size):
    """Sums beyond what a double holds: scores of vectors that differ in one component by little."""
    chance = random.Random(3)
    rows = [(k, [float(round(chance.uniform(-size, size))) for _ in range(6)]) for k in range(200)]
    df = spark.createDataFrame([(i, v, 1, 2, "s") for i, v in rows], SCHEMA)
    exact = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    got = topk.top_k(df, F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got) == brute_force(exact)


def test_scores_beyond_a_long_are_its_ends(spark):
    rows = [(0, [1e12, 1e12]), (1, [1e12, 1e12]), (2, [-1e12, 0.0]), (3, [1.0, 0.0])]
    got = {r["vec_id"]: r for r in topk.top_k(make(spark, rows), F.col("vec_id") == 0).collect()}
    assert [got[k]["rank"] for k in (1, 3, 2)] == [1, 2, 3]
    assert (got[1]["score"], got[2]["score"]) == (2**63 - 1, -(2**63))


@pytest.mark.parametrize(("scale", "kind"), [(1, np.float32), (1_000, np.float64), (10**8, np.int64)])
def test_a_block_is_searched_in_the_narrowest_exact_type(scale, kind):
    vectors = np.random.default_rng(5).integers(-9, 10, (3_000, 8)) * scale
    assert topk._exact_type(vectors, vectors) is kind
    pivots, longest = vectors[:4].tolist(), float((vectors.astype(float) ** 2).sum(axis=1).max())
    far = np.sqrt(np.maximum(longest + (vectors[:4].astype(float) ** 2).sum(axis=1) - 2 * vectors.astype(float) @ vectors[:4].T.astype(float), 0))
    block = pd.DataFrame({"vec_id": np.arange(3_000), "v": list(vectors), "far": list(far.astype(np.float32)), "side": 1, "copies": 1})
    found = topk._block_search(pivots, longest, 20)(pd.concat([block[:30].assign(side=0), block], ignore_index=True))
    for k, rows in found.groupby("query_id"):
        scores = vectors @ vectors[k]
        best = [i for i in np.lexsort((np.arange(3_000), -scores)) if i != k][:20]
        assert rows.vec_id.tolist() == best and rows.score.tolist() == scores[best].tolist()
