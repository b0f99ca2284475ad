"""Token counts against whole-text encoding by the library."""

from __future__ import annotations

import random

import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")

from pseudora.llm import tokencount  # noqa: E402


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokencount.MODEL))


def awkward_texts():
    chance = random.Random(5)
    letters = "abc \n\t中文字é😀▁ß<s></s>  "
    texts = [None, "", " ", "a", "<s> </s> <unk>", "▁▁ ▁", "a\0b", "x" * 5000, " " * 4001, "y" + "a" * 3001 + " end"]
    texts += ["".join(chance.choices(letters, k=chance.randint(1, 3000))) for _ in range(60)]
    texts += ["中" * 2000, "😀" * 700, "ab" * 900 + "abc" * 700, "word " * 1500, "a" * 997 + "b" * 1003 + "a" * 1009]
    return texts


@pytest.mark.parametrize(("chunk", "overlap"), [(64, 8), (256, 64), (1 << 15, 1 << 9)])
def test_counts_are_those_of_the_whole_text(spark, documents, library, tmp_path, chunk, overlap):
    texts = awkward_texts()
    rows = [(k if k % 7 else None, text) for k, text in enumerate(texts)] + [(3, texts[-2])] * 2
    documents(rows).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = tokencount.count_tokens(docs, limit=1000, chunk=chunk, overlap=overlap)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = []
    for key, text in rows:
        count = len(library.encode(text or ""))
        want.append((key, len((text or "").encode()), count, count > 1000))
    order = lambda row: (row[0] is None, *[x or 0 for x in row])
    assert sorted(map(tuple, got.collect()), key=order) == sorted(want, key=order)


def test_bytes_that_are_not_utf8_are_counted_as_the_library_reads_them(spark, library, tmp_path):
    broken = [b"a\xff" * 300, b"\xe4\xb8 x" * 200 + "中".encode(), b"\x80" * 500, b"ok"]
    rows = spark.createDataFrame(list(enumerate(broken)), "doc_id long, text binary")
    rows.selectExpr("doc_id", "CAST(text AS STRING) AS text").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    got = {row.doc_id: row.n_tokens for row in tokencount.count_tokens(docs, chunk=64, overlap=16).collect()}
    assert got == {k: len(library.encode(text)) for k, text in enumerate(broken)}


def test_an_empty_table(documents):
    got = tokencount.count_tokens(documents([]))
    assert got.collect() == [] and dict(got.dtypes)["n_tokens"] == "bigint"


def test_chunks_meet_between_characters():
    text = ("aé中😀 " * 50).encode()
    for size, overlap in [(8, 4), (9, 4), (40, 16), (10_000, 16)]:
        parts = list(tokencount.chunks(text, size, overlap))
        whole = b"".join(data[head:] for head, _, data in parts)
        assert whole == text and all(data.decode() for _, _, data in parts)
        assert parts[-1][1] == -1 and all(tail >= head for head, tail, _ in parts[:-1])


def test_chunks_hold_two_overlaps(documents):
    with pytest.raises(ValueError, match="two overlaps"):
        tokencount.count_tokens(documents([(1, "a")]), chunk=100, overlap=51)
