from __future__ import annotations

import math
import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd
import pytest

from pseudora.llm import labelled, quality, toxicity

LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture
def corpus(prose):
    """Good prose, junk of several kinds, and insults, plain or disguised."""
    chance = random.Random(8)
    rows, marks = [], []
    for k in range(500):
        words = prose(chance.choice([15, 60, 200])).split()
        junk, toxic = k % 5 == 0, k % 4 == 1
        if junk:
            kind = k % 3
            if kind == 0:
                words = [w for w in words[:8] for _ in range(len(words) // 4 + 2)]
            elif kind == 1:
                words = [w.upper() + "!!" for w in words]
            else:
                words = [w + chance.choice(["###", "***", "%%%"]) for w in words]
        if toxic:
            insult = chance.choice(["zanubid", "krewolt", "pottifex"])
            words.insert(chance.randrange(len(words)), insult.upper() if k % 8 == 1 else insult)
        rows.append((k, " ".join(words)))
        marks.append((k, 0 if junk else 1, int(toxic)))
    return rows, marks


def accuracy(report, marks, label):
    truth = {m[0]: m[label] for m in marks}
    rows = [r for r in report.collect() if r["held_out"] and r["doc_id"] in truth]
    assert all(0 <= r["score"] <= 1 for r in rows)
    return sum(r["predicted"] == truth[r["doc_id"]] for r in rows) / len(rows)


def test_quality_on_held_out_documents(spark, documents, corpus):
    rows, marks = corpus
    labels = spark.createDataFrame(marks, LABELS)
    docs = documents([*rows, (1000, None), (1001, ""), (1002, "x"), (1003, "wörter " * 30000), rows[0]])
    report = quality.quality_report(docs, labels)
    assert report.count() == len(rows) + 5
    assert accuracy(report, marks, 1) >= 0.95
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in report.collect())
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    gone = {r["doc_id"] for r in report.collect() if r["predicted"] == 0}
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in docs.collect()} - gone


def test_rules_as_columns_equal_rules_on_arrays(spark, documents, corpus):
    rows, marks = corpus
    model = quality.train(documents(rows), spark.createDataFrame(marks, LABELS))
    assert 0 < len(model.rules) < 200
    x = quality.statistics([t.encode() for _, t in rows])
    margin = model.intercept + sum(w * quality._holds(x, r) for r, w in zip(model.rules, model.weights, strict=True))
    found = quality.score_quality(documents(rows), model).select("doc_id", "score").collect()
    for r in found:
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-margin[r["doc_id"]])))


def test_statistics_of_small_texts():
    a, b, empty = quality.statistics(["Go go GO stop!\n".encode(), "ä ## 12".encode(), b""])
    named = dict(zip(quality.STATISTICS, a, strict=True))
    assert named["words"] == pytest.approx(math.log1p(4))
    assert (named["distinct_words"], named["repeated_next"], named["most_frequent"]) == (0.5, 0.5, 0.75)
    assert named["upper"] == pytest.approx(3 / 10)
    assert dict(zip(quality.STATISTICS, b, strict=True))["symbol_words"] == pytest.approx(1 / 3)
    assert not empty.any()


def test_statistics_of_a_large_batch_take_little_memory():
    texts = [f"{k} Several words of a Text, 12 in all. " * 50 for k in range(8000)] + [None, ""]
    batch = pd.Series(texts)
    tracemalloc.start()
    try:
        found = quality._statistics_of(batch)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(len(t or "") for t in texts) > 15_000_000 and most < 40_000_000
    some = [0, 4321, 8000, 8001]
    want = quality.statistics([(texts[k] or "").encode() for k in some])
    assert np.array_equal(found.to_numpy()[some], want)


def test_lasso_drops_useless_rules():
    chance = np.random.default_rng(0)
    x = chance.random((600, len(quality.STATISTICS)))
    y = (x[:, 2] > 0.6).astype(int)
    model = quality.fit(x, y)
    strong = quality.fit(x, y, lasso=3e-2)
    assert 0 < len(strong.rules) < len(model.rules) < quality.TREES * (2 ** (quality.DEPTH + 1) - 2)
    heaviest = max(zip(strong.weights, strong.rules, strict=True), key=lambda found: abs(found[0]))[1]
    assert {at for at, _, _ in heaviest} == {2}


def test_toxicity_on_held_out_documents(spark, documents, corpus):
    rows, marks = corpus
    labels = spark.createDataFrame([*marks, (3, 0, None), (7, 1, 1), (7, 1, 0)], LABELS)
    odd = [(1000, None), (1001, ""), (1002, "you zanubbid there"), (1003, "a k.r.e.w.o.l.t b"), (1004, "p o t t i f e x")]
    docs = documents([*rows, *odd, (1005, "word " * 40000), rows[0]])
    report = toxicity.toxicity_report(docs, labels)
    assert report.count() == len(rows) + 7
    assert accuracy(report, marks, 2) >= 0.97
    found = {r["doc_id"]: r["predicted"] for r in report.collect()}
    assert [found[k] for k in range(1000, 1006)] == [0, 0, 1, 1, 1, 0]


def test_kernel_counts_gapped_subsequences():
    same = toxicity.kernel(toxicity.explicit("moron"), toxicity.explicit("moron"))
    gapped = toxicity.kernel(toxicity.explicit("moron"), toxicity.explicit("moxron"))
    other = toxicity.kernel(toxicity.explicit("moron"), toxicity.explicit("planet"))
    assert same == pytest.approx(1) and other < 0.05 < 0.4 < gapped < 1


def test_margins_equal_the_plain_kernel_expansion():
    model = toxicity.fit_words(["zanubid", "krewolt"], ["table", "window", "garden", "zebra", "krone"])
    words = ["zanubid", "zaxnubid", "krewolt", "window", "ab", "", "x" * 50 + "krewolt" + "y" * 40]
    for word, margin in zip(words, model.margins(words), strict=True):
        pieces = [sum(model.table[k] * v for k, v in toxicity.explicit(p).items()) for p in toxicity._pieces(word) if p]
        plain = max([m + model.shift for m in pieces], default=toxicity.LOWEST)
        assert margin == pytest.approx(max(plain, toxicity.LOWEST), abs=1e-6)


def test_samples_skip_the_held_out_fold(spark):
    labels = spark.createDataFrame([(k, k % 2, None) for k in range(200)] + [(None, 1, 1)], LABELS)
    rows = labelled.labelled_sample(labels, "quality", 60).collect()
    assert len(rows) == 60 and sum(r["label"] for r in rows) == 30
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 for r in rows)


def test_empty_tables(spark, documents):
    none = spark.createDataFrame([], LABELS)
    for report in (quality.quality_report, toxicity.toxicity_report):
        assert report(documents([]), none).count() == 0
        row = report(documents([(1, "some text")]), none).first()
        assert 0 <= row["score"] <= 1 and row["held_out"] == (zlib.crc32(b"1") % 5 == 0)


@pytest.mark.parametrize("texts", [[f"word{k} and some more" for k in range(6)], ["the same text"] * 200])
def test_nothing_to_split(spark, documents, texts):
    """Both labels, yet no tree finds a split: the share of good documents is every score."""
    docs = documents([(k, text) for k, text in enumerate(texts)])
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(len(texts))], LABELS)
    found = quality.quality_report(docs, labels).collect()
    assert len(found) == len(texts) and len({r["score"] for r in found}) == 1
    assert 0 < found[0]["score"] < 1


def test_an_id_on_very_many_rows_reaches_the_driver_once(spark, documents, monkeypatch):
    rows = [(1, f"text number {k}") for k in range(20_000)] + [(k, "another " * k) for k in range(2, 40)]
    labels = spark.createDataFrame([(k, k % 2, k % 2) for k in range(40)], LABELS)
    seen, fit = [], quality.fit
    monkeypatch.setattr(quality, "fit", lambda x, y: seen.append(len(y)) or fit(x, y))
    quality.train(documents(rows), labels)
    ids = [k for k in range(1, 40) if zlib.crc32(str(k).encode()) % 5]
    assert seen == [len(ids)]
