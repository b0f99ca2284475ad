from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, size string, rep int, quality string"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]) with extra columns whose names operators use."""

    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or ""), "x", 1, "q") for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts) if full else spark.createDataFrame([], DOCS)

    return make


@pytest.fixture
def prose():
    """Random words from a small vocabulary."""
    chance = random.Random(3)
    vocabulary = ["".join(chance.choices("abcdeghilmnorst", k=chance.randint(2, 7))) for _ in range(400)]

    def make(n):
        return " ".join(chance.choices(vocabulary, k=n))

    return make
