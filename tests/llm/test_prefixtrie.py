"""The conversation trie against a dictionary of all prefixes."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from pseudora.llm import prefixtrie

SCHEMA = "conv_id long, turn long, role string, text string, path string, steps int, skeleton long"


def table(spark, rows, parts=3):
    df = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], SCHEMA)
    return df.repartition(parts) if rows else df


def brute_force(rows):
    own = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own[conv_id].append((turn is not None, turn or 0, (role or "", text or "")))
    own = {c: [step for *_, step in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c, turns in sorted(own.items()):
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100 if c >= 0 else -(abs(c) % 100))
        path = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(path) + 1):
            members[path[:d]].append((c, len(path) == d))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[c] for c in children[node]) or 1
        own_saved = (len(members[node]) - 1) * len(node[-1][1]) if node else 0
        saved[node] = own_saved + sum(saved[c] for c in children[node])
    found = []
    for node, convs in members.items():
        ends = ",".join(str(c) for c, end in convs if end)
        above = members[node[:-1]][0][0] if node else None
        counts = (len(convs), len(children[node]), leaves[node], saved[node])
        found.append((convs[0][0], len(node), above, *counts, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(found, key=str)


def conversations(chance):
    rows = []
    for c in [*range(0, 420), *range(-230, -190), 10**12, 10**12 + 7]:
        if c % 100 == 0 and chance.random() < 0.2:
            continue
        style = chance.random()
        for turn in range(chance.choice([1, 2, 3, 8, 30])):
            if style < 0.4:
                row = ("user", f"same {turn}")  # one long conversation that many share
            else:
                row = (chance.choice(["user", "system", None]), chance.choice(["é😀", "", None, "b", f"own {c}"]))
            rows.append((c, turn if chance.random() < 0.97 else None, *row))
    rows += [(None, 0, "user", "lost")] * 3 + rows[5:9]
    return rows


def untied(rows):
    """Turns of one number are ordered by digest: give such rows one text."""
    seen = {}
    return [(c, t, *seen.setdefault((c, t), (role, text))) for c, t, role, text in rows]


@pytest.mark.parametrize(("shards", "most_steps"), [(1, 10**6), (8, 10**6), (40, 10**6), (8, 300)])
def test_nodes(spark, shards, most_steps):
    rows = untied(conversations(random.Random(4)))
    got = prefixtrie.prefix_trie(table(spark, rows), shards=shards, most_steps=most_steps)
    assert got.columns == list(prefixtrie.RESULT)
    assert sorted(map(tuple, got.collect()), key=str) == brute_force(rows)


def test_many_copies_of_one_conversation_are_cut(spark):
    rows = [(1000 * c, t, "user", f"turn {t}") for c in range(3000) for t in range(3)]
    df = table(spark, rows)
    paths = prefixtrie.rebuilt_paths(prefixtrie.conversation_paths(df))
    skeleton = prefixtrie.splitter_skeleton(paths, 8, 10**6)
    assert len(skeleton.keys) == 7 and len(skeleton.parent) == 4
    assert sorted(map(tuple, prefixtrie.prefix_trie(df, shards=8).collect()), key=str) == brute_force(rows)


def test_turnless_and_absent_bases(spark):
    short = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 2][:4]
    rows = [(c, t, "user", "x") for c in short for t in range(2)]
    got = prefixtrie.prefix_trie(table(spark, rows)).collect()
    assert [tuple(row)[:7] for row in got] == [(short[0], 0, None, 4, 0, 1, 0)]
    assert got[0].ends_sha256 == hashlib.sha256(",".join(map(str, short)).encode()).hexdigest()


def test_no_conversations(spark):
    assert prefixtrie.prefix_trie(table(spark, [])).collect() == []
    assert prefixtrie.prefix_trie(table(spark, [(None, 1, "user", "x")])).collect() == []


def test_common_steps():
    step = ["%032x" % k for k in range(4)]
    assert prefixtrie.common_steps("".join(step), "".join(step[:3])) == 3
    assert prefixtrie.common_steps("".join(step), step[1]) == 0
    assert prefixtrie.common_steps(step[0] + step[1], step[0] + step[2]) == 1
    assert prefixtrie.common_steps("", step[0]) == 0
