from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from pseudora.llm import mixing


def targets(sizes, weights=(3, 1, 2), share=1.5, cap=2):
    """Water filling by exact rounds over sources in order."""
    weight = {k: weights[k % len(weights)] for k in range(len(sizes))}
    got, open_ = {}, set(weight)
    rest = share * sum(sizes)
    while open_:
        level = rest / sum(weight[k] for k in open_)
        full = {k for k in open_ if cap * sizes[k] <= weight[k] * level}
        if not full:
            got |= {k: weight[k] * level for k in open_}
            break
        got |= {k: cap * sizes[k] for k in full}
        rest -= sum(cap * sizes[k] for k in full)
        open_ -= full
    return [got[k] for k in range(len(sizes))]


def highest_quotients(votes, seats):
    quota = [0] * len(votes)
    for _ in range(seats):
        k = max(range(len(votes)), key=lambda i: (votes[i] / (2 * quota[i] + 1), -i))
        quota[k] += 1
    return quota


def test_seats_go_to_the_highest_quotients(spark):
    chance = random.Random(2)
    groups = {g: [chance.choice([0, 1, 3, 3, 50, 700, chance.random() * 90]) for _ in range(20)] for g in range(6)}
    seats = {0: 0, 1: 1, 2: 17, 3: 200, 4: 999, 5: 40}
    rows = [(g, k, float(v), seats[g]) for g, votes in groups.items() for k, v in enumerate(votes)]
    df = spark.createDataFrame(rows, "g int, k int, votes double, seats int")
    found = {(r["g"], r["k"]): r["quota"] for r in mixing.apportioned(df, ["g"], ["k"]).collect()}
    for g, votes in groups.items():
        assert [found[g, k] for k in range(20)] == highest_quotients(votes, seats[g])


@pytest.fixture
def corpus(prose):
    chance = random.Random(4)
    sources = ["b"] * 60 + ["a"] * 12 + ["é"] * 9 + ["c"] * 7 + [None] * 6 + ["Z"] * 5
    return [(k, prose(chance.choice([1, 5, 40, 300])), s) for k, s in enumerate(sources)]


@pytest.mark.parametrize("shard_tokens", [500, 10**7])
def test_targets_and_takes(documents, corpus, shard_tokens):
    rows = [*corpus, (500, None, "b"), (501, "", "zz"), (502, "one two", "a"), (502, "one two", "a")]
    found = mixing.mix_sources(documents(rows), block_tokens=8, shard_tokens=shard_tokens).collect()
    assert len(found) == len(rows)
    order = sorted({s for _, _, s in rows if s is not None}, key=str.encode) + [None]
    sizes = [sum(len((t or "").split()) for _, t, s in rows if s == source) for source in order]
    want = dict(zip(order, targets(sizes), strict=True))
    taken = dict.fromkeys(order, 0)
    for r in found:
        assert r["source_size"] == sizes[order.index(r["source"])]
        assert r["target"] == pytest.approx(want[r["source"]])
        assert 0 <= r["taken"] <= 2 * r["size"]
        taken[r["source"]] += r["taken"]
    for source in order:
        assert abs(taken[source] - want[source]) <= max(16, 0.02 * want[source])


def test_runs_agree(documents, corpus):
    once, again = (sorted(mixing.mix_sources(documents(corpus, parts)).drop("shard").collect()) for parts in (2, 5))
    assert once == again


def test_no_rows(documents):
    assert mixing.mix_sources(documents([])).count() == 0


def test_positions_follow_the_order(spark):
    df = spark.createDataFrame([(x,) for x in ["b", None, "a", "ö", "z"]], "source string")
    found = mixing.ranked(df, [F.asc_nulls_last("source")], "position").collect()
    assert {r["source"]: r["position"] for r in found} == {"a": 0, "b": 1, "z": 2, "ö": 3, None: 4}


def test_seats_of_all_rows_need_no_common_task(spark, documents, prose, monkeypatch):
    chance = random.Random(5)
    votes = [chance.choice([0, 1, 3, 3, 50, chance.random() * 90]) for _ in range(300)]
    df = spark.createDataFrame([(k, float(v), 701) for k, v in enumerate(votes)], "k int, votes double, seats int")
    found = {r["k"]: r["quota"] for r in mixing.apportioned(df, [], ["k"]).collect()}
    assert [found[k] for k in range(300)] == highest_quotients(votes, 701)
    assert mixing.apportioned(df.where("k < 0"), [], ["k"]).count() == 0
    groups, whole = [], mixing.apportioned
    monkeypatch.setattr(mixing, "apportioned", lambda df, group, ties: groups.append(group) or whole(df, group, ties))
    rows = [(k, prose(9), f"s{k}") for k in range(40)]
    assert mixing.mix_sources(documents(rows)).count() == 40
    assert groups == [[], ["position"]]


def test_rows_without_or_with_equal_ids_are_dealt_to_all_shards(documents, prose, monkeypatch):
    texts = [prose(20) for _ in range(600)]
    for ids in ([None] * 600, [7] * 600):
        found = mixing.mix_sources(documents(list(zip(ids, texts, strict=True))), shard_tokens=1000).collect()
        shards = [r["shard"] for r in found]
        assert len(set(shards)) == 12 and max(map(shards.count, set(shards))) < 120
    monkeypatch.setattr(mixing, "HOT_ROWS", 50)  # rows alike in id and text, too
    found = mixing.mix_sources(documents([(None, texts[0])] * 600), shard_tokens=1000).collect()
    assert len({r["shard"] for r in found}) == 12
    assert abs(sum(r["taken"] for r in found) - found[0]["target"]) <= 12 * mixing.BLOCK_TOKENS


def test_sizes_and_targets_in_sql(spark, documents, corpus):
    """Size, source size and an unstopped target, by an independent engine."""
    import duckdb

    found = mixing.mix_sources(documents(corpus)).toPandas()
    docs = documents(corpus).toPandas()
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(
        r"""WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents)
        SELECT doc_id, size, sum(size) OVER (PARTITION BY source) AS source_size FROM d ORDER BY doc_id"""
    ).fetchall()
    got = found.sort_values("doc_id")[["doc_id", "size", "source_size"]]
    assert [tuple(map(int, row)) for row in got.to_numpy()] == [tuple(map(int, row)) for row in want]
