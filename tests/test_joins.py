"""Spread joins against plain joins on skewed data, and their plans."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from pseudora.plans import skew


def rows(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def sides(spark):
    """Left: a third hot key, a third NULL keys, exact copies. Right: another and the same hot."""
    left = spark.range(0, 900, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN NULL ELSE concat('k', id) END AS k",
        "CASE WHEN id % 5 = 0 THEN 'a' ELSE 'b' END AS j",
        "CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS l",
    )
    many = spark.range(0, 300, 1, 4).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'k2' WHEN id % 10 = 1 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
        "ELSE concat('k', id) END AS k",
        "CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS j",
        "id % 4 AS m",
    )
    unique = spark.sql(
        "SELECT * FROM VALUES ('hot', 'a', 1), ('hot', 'b', 2), ('k2', 'b', 3), ('k5', 'a', 4), "
        "(NULL, 'a', 5) AS t(k, j, u)"
    )
    return left, many, unique


@pytest.mark.parametrize("rows_per_task", [1, 7, 40, 10_000])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
def test_many_and_unique(sides, keys, rows_per_task):
    left, many, unique = sides
    if keys == ["k"]:
        many, unique = many.drop("j"), unique.where("u > 1").drop("j")
    got = skew.spread_left_join(
        left, keys, many=many, unique=[unique], rows_per_task=rows_per_task
    )
    plain = left.join(many, keys, "left").join(unique, keys, "left").select(*got.columns)
    assert rows(got) == rows(plain)
    assert got.columns[: len(left.columns)] == left.columns


def test_spread_by_content(sides):
    left, many, _ = sides
    got = skew.spread_left_join(
        left,
        ["k"],
        many=many.drop("j"),
        left_spread_by=F.xxhash64("l"),
        many_spread_by=F.xxhash64("m"),
        rows_per_task=5,
    )
    assert rows(got) == rows(left.join(many.drop("j"), "k", "left").select(*got.columns))


def test_heavy_keys(sides):
    left, many, _ = sides
    by_key = {r.h: r.k for r in left.select("k", skew.key_hash([F.col("k")]).alias("h")).distinct().collect()}
    hashes = [side.select(skew.key_hash([F.col("k")]).alias("h")) for side in (left, many)]
    of_left, of_many = skew.count_keys(hashes)
    for most, want in [(150, {"hot": (2, 1)}), (60, {"hot": (5, 1), "k2": (1, 2)})]:
        grid = skew.heavy_grid(of_left, of_many, most)
        assert {by_key[key]: cut for key, cut in grid.items()} == want
    assert skew.heavy_grid(of_left, of_many, 300) == {}
    assert skew.count_keys([hashes[0].limit(0)]) == [{}]


def test_keys_are_counted_while_a_side_is_written(spark, sides, tmp_path):
    left, many, _ = sides
    watched, counts = skew.measured(left, [F.col("k")])
    watched.write.parquet(str(tmp_path / "left"))
    assert counts() == skew.count_keys([left.select(skew.key_hash([F.col("k")]).alias("h"))])[0]
    stored = spark.read.parquet(str(tmp_path / "left"))
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup
    spark.sparkContext.setJobGroup("measured", "")
    try:
        got = skew.spread_left_join(
            stored, ["k"], many=many.drop("j"), left_counts=counts(), many_counts={}, rows_per_task=50
        )
        assert not jobs("measured")  # no side was read to plan the join
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert rows(got) == rows(stored.join(many.drop("j"), "k", "left").select(*got.columns))


def test_copies_of_a_heavy_key_end_up_in_several_tasks(spark, sides):
    left, _, unique = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = skew.spread_left_join(
            left, ["k"], unique=[unique.where("u > 1").drop("j")], rows_per_task=20
        )
        sizes = (
            joined.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
        )
        nulls = joined.where("k IS NULL").select(F.spark_partition_id()).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(sizes) >= 4
    assert max(r["count"] for r in sizes) < 150
    assert nulls >= 4


def test_lookup_is_broadcast_only_when_it_measures_small(spark, sides):
    left, many, _ = sides
    policy = many.drop("j")
    small = skew.lookup_left_join(left, policy, ["k"])
    for limit in (10, 10**6):
        large = skew.lookup_left_join(left, policy, ["k"], max_rows=10, rows_per_task=limit, counted=left.select("k"))
        assert rows(small) == rows(large.select(*small.columns))
    assert skew.fits_broadcast(policy, max_rows=300)
    assert not skew.fits_broadcast(policy, max_rows=299)
    assert not skew.fits_broadcast(policy, max_chars=100)
    assert skew.fits_broadcast(policy.limit(0), max_rows=0)


def test_identities_are_shuffled_once_for_all_controls(spark, sides):
    left, many, unique = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = skew.spread_left_join(left, ["k", "j"], many=many, unique=[unique])
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2
    cells = [line for line in plan.splitlines() if "hashpartitioning" in line and "_left_cell" in line]
    assert len(cells) == 3  # left, many, unique


def test_large_lookups_read_the_left_side_once_and_deal_by_content(spark, sides, tmp_path):
    left, many, _ = sides
    left.write.parquet(str(tmp_path / "left"))
    stored = spark.read.parquet(str(tmp_path / "left"))
    df = skew.lookup_left_join(stored, many.drop("j"), ["k"], max_rows=1)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "monotonically_increasing_id" not in plan


def test_large_lookups_are_copied_for_hot_keys_only(spark, sides):
    """300 rows of one key on the left in parts of 50: its lookup rows go to 6 cells, others to one."""
    left, many, _ = sides
    policy = many.drop("j").where("k IS NOT NULL")
    counts = skew.count_keys([left.select(skew.key_hash([F.col("k")]).alias("h"))])[0]
    grid = skew.heavy_grid(counts, {}, 50)
    assert list(grid.values()) == [(6, 1)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.lookup_left_join(left, policy, ["k"], max_rows=1, rows_per_task=50)
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    hot, rest = policy.where("k = 'hot'").count(), policy.where("k <> 'hot'").count()
    copied = skew._with_parts(policy, _grid_of(spark, grid), skew.key_hash([F.col("k")]))
    copied = copied.select(F.explode(F.sequence(F.lit(1), "_left_parts")))
    assert copied.count() == 6 * hot + rest < 2 * policy.count() + 6 * hot
    assert "SortMergeJoin" in plan


def _grid_of(spark, grid):
    return spark.createDataFrame([(key, *cut) for key, cut in grid.items()], skew._GRID)
