"""The filter audit against documents filtered one by one in every order."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np

from pseudora.llm import filteraudit, textvec

WORD = re.compile(r"[^\x20\x09-\x0D]+")
NAMES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def facts(text):
    words = WORD.findall(text)
    capitals, symbols = len(re.findall("[A-Z]", text)), len(re.findall(r"[#$%&*|]", text))
    return [len(words), len(set(words)), capitals, len(text), symbols]


def brute_force(rows, labels):
    good, toxic = ({d for d, *row in labels if d is not None and row[k] == 1} for k in (0, 1))
    first = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    parts = defaultdict(list)
    for doc_id, text, lang in rows:
        words, distinct, capitals, points, symbols = facts(text or "")
        fails = {"A": words < 200, "B": 100 * distinct < 50 * words, "C": 100 * capitals > 3 * points, "D": symbols > 0}
        fails["E"] = doc_id is not None and doc_id > first[text or ""]
        parts[lang or ""].append(({f for f in fails if fails[f]}, doc_id in good, doc_id in toxic))
    want, shapley = [], Counter()
    for part, docs in parts.items():
        for order in map("".join, permutations("ABCDE")):
            for step, f in enumerate(order, 1):
                before = set(order[: step - 1])
                gone = [d for d in docs if f in d[0] and not d[0] & before]
                kept = sum(not d[0] & (before | {f}) for d in docs)
                redundant = sum(f in d[0] and bool(d[0] & before) for d in docs)
                unique = sum(d[0] == {f} for d in docs)
                shapley[part, f] += len(gone)
                want.append([part, order, step, kept, len(gone), redundant, unique, sum(d[1] for d in gone), sum(d[2] for d in gone)])
    return sorted((*row, shapley[row[0], row[1][row[2] - 1]]) for row in want)


def documents_with_langs(spark, rows):
    full = [(d, t, lang, 1, "x", b"y") for d, t, lang in rows]
    df = spark.createDataFrame(full, "doc_id long, text string, lang string, part int, digest string, n binary")
    return df.repartition(3)


def test_audit(spark, prose, tmp_path):
    chance = random.Random(8)
    pool = [prose(n) for n in (0, 5, 199, 200, 260, 300)] + [" ".join(["Aa b c$"] * 80), "É " * 250, "x" * 9000, None, "  \xa0 a"]
    rows = []
    for k in range(260):
        text = chance.choice(pool) if k % 2 else prose(chance.randint(150, 250)) + chance.choice(["", " |", " ABC DEF" * 5])
        rows.append((None if k % 19 == 0 else k % 240, text, chance.choice(["en", "de", None, ""])))
    rows += [(7, pool[3], "en")] * 5
    labels = [(k, chance.choice([0, 1, None]), chance.choice([0, 1, None])) for k in range(0, 240, 3)] + [(None, 1, 1), (3, 1, 0)]
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    documents_with_langs(spark, rows).write.parquet(str(tmp_path / "docs"))
    got = filteraudit.interaction_audit(spark.read.parquet(str(tmp_path / "docs")), known)
    assert got.columns == ["part", "filter_order", "step", *NAMES]
    assert sorted(map(tuple, got.collect())) == brute_force(rows, labels)


def test_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filteraudit.interaction_audit(documents_with_langs(spark, []), labels).collect() == []


def test_transducer():
    chance = random.Random(2)
    texts = ["".join(chance.choices("aB \n\t中😀#|\x00\x0b\xa0é", k=chance.randint(0, 60))) for _ in range(300)]
    texts += ["", "", "a", " ", "A", "ab" * 50_000]
    raw = "".join(texts).encode()
    bounds = np.cumsum([0, *(len(t.encode()) for t in texts)])
    got = np.array(filteraudit.transduce(np.frombuffer(raw, dtype=np.uint8), bounds)).T.tolist()
    assert got == [facts(text) for text in texts]


def test_colliding_words_are_told_apart():
    words = [b"ab", b"cd", b"ab", b"xyz", b"cd", b"ab", b"q"]
    raw = np.frombuffer(b" ".join(words), dtype=np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    text = np.array([0, 0, 0, 0, 1, 1, 1])
    same = np.zeros(len(words), dtype=np.uint64)
    assert filteraudit.distinct_words(raw, text, start, end, same, 2).tolist() == [3, 3]
    hashes = textvec.span_hashes(raw, start, end)
    assert len(set(hashes.tolist())) == 4
