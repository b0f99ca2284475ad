"""Operators that keep the caller's columns, with columns that are called like their own."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from pseudora.llm import decontamination, ngramjoin, packing, quality, secrets

NAMES = (
    "row number _row _key _words _length _hash _hashes _check _window _items _at _span _count n_hit n_words n_items "
    "items items_sha256 contaminated _item_ids spans _spans secrets _lower _postings0 _postings1 _found0 _found1 "
    "statistics _statistics score _score label component_id kept members first n f1 f2 keys _key_hash _left_cell "
    "_right_cell _left_parts _right_parts _hit doc s"
).split()


@pytest.fixture(scope="module")
def crowded(spark, tmp_path_factory):
    """Documents with a column for every internal name."""
    words = [f"wort{k}" for k in range(60)]
    rows = [(k, " ".join(words[k % 30 : k % 30 + 25]) + (" secret=abcdef123456" if k % 3 == 0 else "")) for k in range(60)]
    rows += [(3, "A! B! " * 30), (None, None), (None, ""), (61, "gut " * 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs = docs.withColumns({name: F.concat(F.lit(f"{name} of "), F.coalesce("doc_id", F.lit(-1))) for name in NAMES})
    path = str(tmp_path_factory.mktemp("crowded") / "docs")
    docs.repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def unchanged(df, docs, without=()):
    """Every row that is left is one of the rows that were there, but for the columns named."""
    kept = [name for name in docs.columns if name not in without]
    assert df.columns == docs.columns
    assert not df.select(kept).exceptAll(docs.select(kept)).count()
    return df.count()


@pytest.fixture(scope="module")
def tables(spark):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    item = " ".join(f"wort{k}" for k in range(20, 40))
    return labels, spark.createDataFrame([(1, item)], "item_id long, text string")


def test_stages_leave_columns_alone(crowded, tables):
    labels, benchmark = tables
    unchanged(quality.keep_good(crowded, labels), crowded)
    assert 2 < unchanged(ngramjoin.keep_one(crowded), crowded) < crowded.count()
    assert 2 < unchanged(decontamination.remove_contaminated(crowded, benchmark), crowded) < crowded.count()
    redacted = secrets.redact_secrets(crowded)
    assert unchanged(redacted, crowded, without=["text"]) == crowded.count()
    assert redacted.where("text LIKE '%[SECRET]%'").count() == 20


def test_results_take_the_place_of_columns_so_called(crowded, tables):
    labels, benchmark = tables
    judged = decontamination.judged(crowded, benchmark)
    assert judged.columns == crowded.columns and dict(judged.dtypes)["contaminated"] == "boolean"
    unchanged(judged, crowded, without=["n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
    found = secrets.find_secrets(crowded)
    assert found.columns == crowded.columns and found.where(F.size("secrets") > 0).count() == 20
    rated = quality.score_quality(crowded, quality.train(crowded, labels))
    assert rated.columns == crowded.columns and dict(rated.dtypes)["score"] == "double"


def test_many_dropped_keys_take_a_join_instead_of_a_broadcast(spark):
    rows = packing.packed(spark.range(100).withColumnRenamed("id", "row")).withColumn("key", F.col("row.row") % 10)
    gone = spark.range(3).select(F.col("id").alias("key"))
    for most in (2, 3):
        left = packing.unpacked(packing.without(rows, gone, "key", most), ["row"])
        assert sorted(r.row for r in left.collect()) == [k for k in range(100) if k % 10 > 2]


@pytest.mark.parametrize("max_found", [0, 1000])
def test_contaminated_texts_are_found_either_way(crowded, tables, max_found):
    _, benchmark = tables
    small = decontamination.judged(crowded.select("doc_id", "text"), benchmark, max_found=max_found)
    want = decontamination.judged(crowded.select("doc_id", "text"), benchmark)
    assert sorted(map(str, small.collect())) == sorted(map(str, want.collect()))
    left = decontamination.remove_contaminated(crowded, benchmark, max_found=max_found).count()
    assert left == want.where("NOT contaminated").count()
