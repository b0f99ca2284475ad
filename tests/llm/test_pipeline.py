from __future__ import annotations

import random
import re
from collections import Counter

import corpus_pipeline
from pyspark.sql import functions as F

from pseudora.llm import decontamination, mixing, ngramjoin, quality, secrets


def tables(spark, documents, prose, folder):
    chance = random.Random(6)
    base = [(k, prose(chance.choice([30, 80, 200])), chance.choice("aab")) for k in range(200)]
    item = prose(20)
    rows = []
    for k, text, source in base:
        if k % 9 == 0:
            text = " ".join(w.upper() + "!!" for w in text.split())
        if k % 17 == 1:
            text += " " + item
        if k % 13 == 2:
            text += " token = 96d17ded865a61704b5b8dc58aafba7d26a3c1ef"
        rows.append((k, text, source))
    rows += [(300 + k, rows[k][1].replace("a", "a", 1), "c") for k in range(30)]
    rows += [(400, None, None), (401, "", "a")]
    documents(rows).write.parquet(f"{folder}/documents.parquet")
    labels = [(k, 0 if k % 9 == 0 else 1, 0) for k in range(200)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return rows


def test_every_stage_takes_effect_on_what_the_one_before_kept(spark, documents, prose, tmp_path):
    folder = str(tmp_path)
    tables(spark, documents, prose, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    bench = spark.read.parquet(f"{folder}/benchmark.parquet")
    columns = docs.columns

    report = quality.quality_report(docs, labels).where("predicted = 1")
    docs = docs.join(report.select("doc_id"), "doc_id", "left_semi")
    report = ngramjoin.jaccard_components(docs).where("doc_id = component_id")
    docs = docs.join(report.select("doc_id"), "doc_id", "left_semi")
    report = decontamination.contamination_report(docs, bench).where("NOT contaminated")
    docs = docs.join(report.select("doc_id"), "doc_id", "left_semi")
    clean = secrets.redact_secrets(docs).withColumn("n_chars", F.length("text").cast("long")).select(*columns)
    want = sorted(mixing.mix_sources(clean).collect())

    got = corpus_pipeline.run(spark, folder)
    assert sorted(got.collect()) == want
    assert 100 < len(want) < 200 and [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier"


WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text):
    words = WORD.findall(lower(text))
    return {tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))} if words else set()


def one_of_each(rows):
    """Rows that stay when each group of near copies keeps that with the smallest id, NULL last."""
    sets, root = [shingles(text) for _, text in rows], list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 90 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(k)
    return [min(g, key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k)) for g in groups.values()]


def contaminated(text, items):
    words, hit, windows = PLAIN.findall(lower(text)), set(), set()
    for item in items:
        w = PLAIN.findall(lower(item))
        n = min(13, len(w))
        windows |= {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} if n else set()
    for window in windows:
        for k in range(len(words) - len(window) + 1):
            if tuple(words[k : k + len(window)]) == window:
                hit |= set(range(k, k + len(window)))
    return bool(hit) and 20 * len(hit) >= len(words)


def test_stages_against_brute_force(spark, documents, prose, tmp_path):
    """What the second and third stage keep, ids NULL, repeated and with unrelated texts among them."""
    folder = str(tmp_path)
    rows = [(d, text) for d, text, _ in tables(spark, documents, prose, folder)]
    extra = [(None, rows[3][1]), (None, "only one without an id " * 9), (None, None), (5, rows[40][1]), (5, rows[5][1]), (7, "  ")]
    docs = documents(rows + extra)
    docs.write.parquet(f"{folder}/all.parquet")
    docs = spark.read.parquet(f"{folder}/all.parquet")
    kept = corpus_pipeline.distinct(spark, docs, folder).select("doc_id", "text").collect()
    plain = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = [plain[k] for k in one_of_each(plain)]
    assert Counter((d, lower(t)) for d, t in kept) == Counter((d, lower(t)) for d, t in want)
    items = [r.text for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = corpus_pipeline.decontaminated(spark, docs, folder).select("doc_id", "text").collect()
    assert Counter(map(tuple, clean)) == Counter(r for r in plain if not contaminated(r[1], items))


def test_empty_tables_pass_through(spark, documents, prose, tmp_path):
    folder = str(tmp_path)
    tables(spark, documents, prose, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs_after = stage(spark, docs, folder)
        assert docs_after.count() == 0


def test_stages_keep_the_columns(spark, documents, prose, tmp_path):
    folder = str(tmp_path)
    tables(spark, documents, prose, folder)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.schema.simpleString() == spark.read.parquet(f"{folder}/documents.parquet").schema.simpleString()
    assert not docs.where("text LIKE '%96d17ded%'").count()
