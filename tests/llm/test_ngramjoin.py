from __future__ import annotations

import random
import re

import numpy as np
import pytest

from pseudora.llm import ngramjoin, textvec
from pseudora.llm.components import connected


def shingles(text, size=3):
    words = [w.lower() for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[k : k + width]) for k in range(len(words) - width + 1))


def brute_force(rows, percent=90):
    """Components over doc_ids, every pair compared."""
    parent = {i: i for i, _ in rows if i is not None}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t)) for i, t in rows]
    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            if None in (i, j) or not x or not y:
                continue
            if 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted((i, len(s), root(i)) for i, s in sets if i is not None)


def near_copies(prose, seed=5):
    """Chains of copies with few changed words, sizes from one word to long texts."""
    chance = random.Random(seed)
    rows, next_id = [], 0
    for n in (1, 2, 3, 5, 12, 14, 25, 40, 60, 90, 150, 400):
        for _ in range(3):
            words = prose(n).split()
            for _ in range(chance.randint(1, 8)):
                rows.append((next_id, " ".join(words)))
                next_id += 1
                words = list(words)
                for _ in range(chance.choice([0, 1, 1, 2])):
                    words[chance.randrange(len(words))] = f"w{chance.randrange(10**6)}"
                if chance.random() < 0.3:
                    words += prose(max(1, n // 25)).split()
    return rows


def result(df):
    return sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect() if r["doc_id"] is not None)


@pytest.mark.parametrize("cell_docs, percent", [(768, 90), (6, 90), (6, 80)])
def test_components_equal_brute_force(spark, documents, prose, cell_docs, percent):
    rows = near_copies(prose)
    rows += [(9001, None), (9002, ""), (9003, " \t\n"), (9004, rows[40][1]), (9004, rows[40][1].upper())]
    found = ngramjoin.jaccard_components(documents(rows), percent=percent, cell_docs=cell_docs)
    assert result(found) == brute_force(rows, percent)


def test_no_rows_and_null_ids(spark, documents):
    assert ngramjoin.jaccard_components(documents([])).count() == 0
    found = ngramjoin.jaccard_components(documents([(None, "a b c"), (7, "A b C"), (None, "x y")])).collect()
    assert sorted((r["n_shingles"], r["component_id"] or -1) for r in found) == [(1, -1), (1, 7), (1, 7)]


def test_keep_one_keeps_the_smallest_id_and_all_columns(documents, prose):
    text = prose(50)
    docs = documents([(3, text), (5, text), (1, prose(40)), (8, None), (9, "")])
    kept = ngramjoin.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 8, 9]


def test_linked_sets_always_share_a_key():
    chance = np.random.default_rng(1)
    tiles = ngramjoin.TileKeys(90)
    for _ in range(300):
        n = int(chance.integers(10, 400))
        a = np.unique(chance.integers(0, 2**63, n, dtype=np.uint64))
        changed = int(n * 0.05)
        b = a.copy()
        b[chance.integers(0, len(b), changed)] = chance.integers(0, 2**63, changed, dtype=np.uint64)
        b = np.unique(b)
        common = len(np.intersect1d(a, b))
        if 100 * common >= 90 * (len(a) + len(b) - common):
            assert set(tiles.of(a)) & set(tiles.of(b)) or np.array_equal(a, b)


def test_size_bands_hold_linked_sizes():
    bands = ngramjoin.size_bands(90)
    where = {n: k for k, (low, high) in enumerate(bands) for n in range(low, min(high, 3000) + 1)}
    for big in range(1, 3000):
        for small in range(-(-90 * big // 100), big + 1):
            assert where[big] - where[small] <= 1


def test_words_are_split_and_lowered_like_bytes(prose):
    texts = ["", " A b\tC\x0bd ", "É é ÉA", "one", "x y z", prose(30)]
    raw = [t.encode() for t in texts]
    words = textvec.Words(raw)
    hashes = words.hashes()
    seen = {}
    for k, t in enumerate(raw):
        own = t.lower().split()
        part = hashes[words.first[k] : words.last[k]]
        assert len(part) == len(own)
        for word, value in zip(own, part.tolist(), strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_connected_follows_long_chains(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (101, 102), (102, 100)]
    found = dict(connected(spark.createDataFrame(edges, "u long, v long")).collect())
    assert {found[k] for k in range(61)} == {0}
    assert {found[k] for k in (100, 101, 102)} == {100}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_keep_one_decides_by_rows(documents, prose):
    a, b, c, d = (prose(60) for _ in range(4))
    rows = [(None, a), (None, a), (None, a + " x"), (7, b), (7, b), (None, b), (3, c), (9, c), (9, d), (None, None), (8, ""), (8, "")]
    kept = sorted((r["doc_id"] is None, r["doc_id"], r["text"]) for r in ngramjoin.keep_one(documents(rows)).collect() if r["text"])
    (only,) = [k for k in kept if k[0]]
    assert only[2] in (a, a + " x")
    assert kept[:-1] == sorted([(False, 7, b), (False, 3, c), (False, 9, d)])
    assert ngramjoin.keep_one(documents(rows)).where("coalesce(text, '') = ''").count() == 3


def test_a_template_family_is_shipped_once(spark, documents, prose, monkeypatch):
    """A large block of one part is done after its star; stragglers meet the others in linear many cells."""
    chance = random.Random(4)

    def family(template, count, first):
        rows = []
        for k in range(count):
            words = template.split()
            words[chance.randrange(len(words))] = f"w{first + k}"
            rows.append((first + k, " ".join(words)))
        return rows

    seen = []
    cut_cells, star_cells = ngramjoin._cut_cells, ngramjoin._star_cells

    def spied(function, at):
        def run(members, *arguments):
            cells = function(members, *arguments)
            seen.append((at, members.count(), cells.count()))
            return cells

        return run

    monkeypatch.setattr(ngramjoin, "_cut_cells", spied(cut_cells, "cut"))
    monkeypatch.setattr(ngramjoin, "_star_cells", spied(star_cells, "star"))
    rows = family(prose(150), 400, 0)
    found = ngramjoin.jaccard_components(documents(rows), cell_docs=20)
    assert {c for _, _, c in result(found)} == {0}
    (_, members, shipped), (_, rest, _) = seen
    assert members == 400 and shipped <= 400 + 400 // 10 + 2 and rest == 0

    # Parts of one block: each large one has its own leaves, which never meet one another.
    schema = "doc_id long, f1 long, n long, block long, part long"
    held = [(k, k, 100, 0, 0 if k < 300 else k) for k in range(303)]
    cells = cut_cells(spark.createDataFrame(held, schema), 90, 20, 10**6).collect()
    assert len(cells) < 303 + 3 * 40
    met = {}
    for r in cells:
        met.setdefault(r["cell"], []).append((r["doc_id"], r["leaf"]))
    assert max(map(len, met.values())) <= 40
    pairs = {
        frozenset((a, b))
        for cell in met.values()
        for a, leaf in cell
        for b, other in cell
        if a != b and (leaf != other or len({x for _, x in cell}) == 1)
    }
    assert all(frozenset((k, s)) in pairs for s in (300, 301, 302) for k in range(303) if k != s)
