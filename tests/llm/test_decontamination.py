from __future__ import annotations

import hashlib
import re
import time

import pytest
from pyspark.sql import functions as F

from pseudora.llm import decontamination as d

UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))


def brute_force(text, items):
    own, hit, met = words(text), set(), set()
    for item_id, item in items:
        w = words(item)
        n = min(13, len(w))
        if not w or item_id is None:
            continue
        windows = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}
        for k in range(len(own) - n + 1):
            if tuple(own[k : k + n]) in windows:
                hit.update(range(k, k + n))
                met.add(item_id)
    ids = ",".join(sorted(map(str, met)))
    digest = hashlib.sha256(ids.encode()).hexdigest()
    return len(own), len(hit), len(met), digest, bool(hit) and 20 * len(hit) >= len(own)


@pytest.fixture
def case(prose):
    long, other = prose(40), prose(25)
    items = [
        (1, long), (2, other), (2, other), (30, "É uno DOS"), (4, "É uno DOS"), (5, None), (6, "..."),
        (None, "lost item words"), (7, "one " * 20),
    ]
    cut = long.split()
    texts = [
        None, "", "!!", long, long.upper(), prose(30) + " " + " ".join(cut[5:30]) + " " + prose(600),
        prose(20) + " " + " ".join(cut[5:17]) + " " + prose(20), "é uno dos", "É, uno-dos! É uno dos", "one " * 50,
        "lost item words", " ".join(cut[:20] + ["x"] + cut[20:]), other + " " + long,
    ]
    return items, list(enumerate(texts)) + [(3, long)]


@pytest.mark.parametrize("max_windows", [10**6, 0])
def test_windows_equal_brute_force(spark, documents, case, max_windows):
    items, rows = case
    bench = spark.createDataFrame([(i, t, "y") for i, t in items], "item_id long, text string, n_words string")
    docs = documents(rows).select("doc_id", "text", "lang")
    found = d.judged(docs, bench, max_windows=max_windows).collect()
    got = sorted((r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in found)
    assert got == sorted((i, *brute_force(t, items)) for i, t in rows)


def test_removal_drops_contaminated_documents_only(spark, documents, case):
    items, rows = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(rows)
    kept = d.remove_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in rows if not brute_force(t, items)[-1])


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert d.contamination_report(documents([]), bench).count() == 0
    row = d.contamination_report(documents([(1, "a b")]), bench).first()
    assert (row["n_words"], row["n_hit"], row["contaminated"]) == (2, 0, False)


def test_words_of_every_kind_of_character(evaluate):
    odd = [*range(0x180), 0x345, 0x2028, 0xD7FF, 0xE000, 0xFFFD, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]
    texts = [f"aZ9{chr(c)}Q0 {chr(c)}{chr(c)}-x" for c in odd]
    assert evaluate(d.words_of, texts) == [words(t) for t in texts]
    counts = evaluate(lambda v: F.regexp_count(v, F.lit(d.WORD_ANY_CASE)), texts)
    assert counts == [len(words(t)) for t in texts]


@pytest.mark.parametrize("word", [d.WORD, d.WORD_ANY_CASE])
def test_words_cost_little_more_than_runs_of_a_plain_class(spark, word):
    text = F.concat(F.col("id").cast("string"), F.lit(" some plain words, 1 \u00e9t\u00e9;" * 200))
    texts = spark.range(0, 4000, 1, 8).select(text.alias("text"))

    def seconds(pattern):
        took = []
        for _ in range(3):
            start = time.perf_counter()
            texts.agg(F.sum(F.regexp_count("text", F.lit(pattern)))).first()
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds(word) < 4 * seconds("[^ ]+")
