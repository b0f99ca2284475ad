"""How five document filters interact: every order of applying them, audited from one pass.

A finite-state transducer reads each text's UTF-8 bytes once. It is table-driven: a table of 256
entries gives what a byte is (part of a word, capital, first byte of a code point, symbol), and the
automaton has two states, inside and outside a word, the next of which depends on the byte alone;
so whole batches of bytes run through the table at once. Each change of state opens or closes a
word, whose span goes into a hash table: spans are placed by 64-bit hash, and every span is
verified byte by byte against the one that opened its slot, so that distinct words are counted
exactly. Whether a text occurs at a smaller doc_id is found by its SHA-256.

Which filters a document fails does not depend on their order. So documents are counted once by part,
failed filters and labels, and all 120 orders are evaluated on these few counts: a filter removes
what fails it and none before it. Only ids, digests and flags are shuffled; counts combine before
it, and of each text only its smallest doc_id is looked for, so copies make no hot key.

Defined results: a NULL text is empty, a NULL lang the part ''; rows that repeat a doc_id count one
by one; a row with a NULL doc_id has no label and no smaller or larger id, so it never fails E; a
document is good or toxic if any of its labels says so; an empty table gives no rows; other columns
are not looked at. Bytes that are not UTF-8 count as code points unless they are continuations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm import textvec
from pseudora.llm.store import stored
from pseudora.plans.skew import spread_left_join

LETTERS = "ABCDE"
SYMBOLS = b"#$%&*|"
MIN_WORDS = 200
MIN_DISTINCT_PERCENT = 50
MAX_CAPITAL_PERCENT = 3
COUNTS = ("n_words", "n_distinct", "n_capitals", "n_points", "n_symbols")

_WORD, _CAPITAL, _LEAD, _SYMBOL = 1, 2, 4, 8
TABLE = np.where(textvec.WORD, _WORD, 0).astype(np.uint8)
TABLE[65:91] |= _CAPITAL
TABLE[[b for b in range(256) if b & 0xC0 != 0x80]] |= _LEAD
TABLE[list(SYMBOLS)] |= _SYMBOL


def _per_text(marks: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many of the sorted places ``marks`` lie in each text."""
    return np.diff(np.searchsorted(marks, bounds))


def _same_bytes(raw: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the spans of ``size`` bytes at ``a`` and ``b`` are equal; no span is empty."""
    first = np.cumsum(size) - size
    step = np.arange(int(size.sum())) - np.repeat(first, size)
    equal = raw[np.repeat(a, size) + step] == raw[np.repeat(b, size) + step]
    return np.logical_and.reduceat(equal, first) if len(size) else np.empty(0, dtype=bool)


def distinct_words(raw: np.ndarray, text: np.ndarray, start: np.ndarray, end: np.ndarray, slot: np.ndarray, texts: int) -> np.ndarray:
    """Distinct words of each text, by a hash table of spans.

    ``text`` and ``slot`` (a hash) of each span place it; the first span in a slot of a text opens
    it, the others are verified against that one. What differs there goes into the next slots, so
    a collision costs another round and never a wrong count.
    """
    found = np.zeros(texts, dtype=np.int64)
    while len(start):
        order = np.lexsort((slot, text))
        text, start, end, slot = text[order], start[order], end[order], slot[order]
        opens = np.ones(len(start), dtype=bool)
        opens[1:] = (text[1:] != text[:-1]) | (slot[1:] != slot[:-1])
        found += np.bincount(text[opens], minlength=texts)
        first = np.flatnonzero(opens)[np.cumsum(opens) - 1]
        size = end - start
        alike = ~opens & (size == size[first])
        alike[alike] = _same_bytes(raw, start[alike], start[first[alike]], size[alike])
        other = ~opens & ~alike
        text, start, end, slot = text[other], start[other], end[other], slot[other]
    return found


def transduce(raw: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """``COUNTS`` of the texts that lie one after the other between ``bounds`` of ``raw``."""
    kind = TABLE[raw]
    inside = (kind & _WORD).astype(bool)
    before = np.concatenate([[False], inside[:-1]]) if len(raw) else inside
    before[bounds[:-1][bounds[:-1] < len(raw)]] = False  # every text starts outside a word
    start = np.flatnonzero(inside & ~before)
    after = np.concatenate([inside[1:], [False]]) if len(raw) else inside
    after[bounds[1:][bounds[1:] > 0] - 1] = False
    end = np.flatnonzero(inside & ~after) + 1
    text = np.searchsorted(bounds, start, side="right") - 1
    distinct = distinct_words(raw, text, start, end, textvec.span_hashes(raw, start, end), len(bounds) - 1)
    words, capitals, leads, symbols = (
        _per_text(marks, bounds)
        for marks in (start, *(np.flatnonzero(kind & flag) for flag in (_CAPITAL, _LEAD, _SYMBOL)))
    )
    return [words, distinct, capitals, leads, symbols]


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow column and the bounds of its texts in them, without a copy."""
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, dtype=np.uint8)
    return raw, bounds


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw, bounds = _buffer(batch.column("_text"))
        counts: list[list[np.ndarray]] = [[] for _ in COUNTS]
        sizes = np.diff(bounds)
        for first, last in textvec.size_ranges(sizes.tolist()):
            low, high = bounds[first], bounds[last]
            for column, part in zip(counts, transduce(raw[low:high], bounds[first : last + 1] - low), strict=True):
                column.append(part)
        digests = [hashlib.sha256(raw[a:b]).digest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        none = np.empty(0, dtype=np.int64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("part"), pa.array(digests, pa.binary())]
            + [pa.array(np.concatenate([none, *column]), pa.int64()) for column in counts],
            names=["doc_id", "part", "digest", *COUNTS],
        )


def text_facts(docs: DataFrame) -> DataFrame:
    """doc_id, part, SHA-256 of the text and ``COUNTS`` of every document."""
    id_type = dict(docs.dtypes)["doc_id"]
    texts = docs.select(
        "doc_id",
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("_text"),
    )
    counts = ", ".join(f"{name} long" for name in COUNTS)
    return texts.mapInArrow(_read, f"doc_id {id_type}, part string, digest binary, {counts}")


def failed_filters() -> Column:
    """Bits of the filters A to D that a document's counts fail."""
    fails = (
        F.col("n_words") < MIN_WORDS,
        100 * F.col("n_distinct") < MIN_DISTINCT_PERCENT * F.col("n_words"),
        100 * F.col("n_capitals") > MAX_CAPITAL_PERCENT * F.col("n_points"),
        F.col("n_symbols") > 0,
    )
    return sum((F.when(bad, F.lit(1 << k)).otherwise(F.lit(0)) for k, bad in enumerate(fails)), F.lit(0))


def failure_patterns(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, good, toxic, n): documents by the set of filters that they fail, as bits."""
    facts = stored(text_facts(docs).select("doc_id", "part", "digest", failed_filters().alias("failed")), "facts")
    known = labels.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    flags = {name: F.coalesce(name, F.lit(False)) for name in ("good", "toxic")}
    marked = stored(spread_left_join(facts, ["doc_id"], unique=[known]).withColumns(flags), "facts")
    pattern = ["part", "failed", "good", "toxic"]
    count = F.count(F.lit(1)).alias("n")
    # A document passes E if its id is the smallest with its text, or missing.
    first = marked.where("doc_id IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    firsts = marked.groupBy("digest", "doc_id", *pattern).agg(count).join(first, ["digest", "doc_id"])
    passing = firsts.select(*pattern, "n").union(
        marked.where("doc_id IS NULL").groupBy(*pattern).agg(count).select(*pattern, "n")
    )
    copy = F.lit(1 << LETTERS.index("E"))
    failing = marked.groupBy(*pattern).agg(count).select("part", F.col("failed") + copy, "good", "toxic", "n")
    every = passing.union(failing).union(
        passing.select("part", F.col("failed") + copy, "good", "toxic", -F.col("n"))
    )
    return every.groupBy(*pattern).agg(F.sum("n").alias("n")).where("n > 0")


def _steps() -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before) for each of the 600 steps."""
    found = []
    for order in map("".join, permutations(LETTERS)):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << LETTERS.index(letter)
            found.append((order, step, bit, before))
            before |= bit
    return found


def interaction_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Counts of every step of every order of the filters, per part."""
    patterns = failure_patterns(docs, labels)
    steps = _steps()
    cases = sorted({(bit, before) for _, _, bit, before in steps})
    case = F.explode(F.array(*[F.struct(F.lit(a).alias("bit"), F.lit(b).alias("before")) for a, b in cases]))
    tried = patterns.withColumn("case", case).select("*", "case.*")
    bit, before, failed, n = (F.col(name) for name in ("bit", "before", "failed", "n"))
    fails, earlier = failed.bitwiseAND(bit) != 0, failed.bitwiseAND(before) != 0
    removed = fails & ~earlier

    def total(chosen: Column, weight: Column = n) -> Column:
        return F.sum(F.when(chosen, weight).otherwise(F.lit(0)).cast("long"))

    # Of the filters that a document fails, each comes first in as many of the orders.
    share = F.floor(F.lit(len(steps) // len(LETTERS)) / F.greatest(F.bit_count("failed"), F.lit(1)))
    counts = tried.groupBy("part", "bit", "before").agg(
        total(~fails & ~earlier).alias("kept"),
        total(removed).alias("removed"),
        total(fails & earlier).alias("redundant"),
        total(failed == bit).alias("unique_fails"),
        total(removed & F.col("good")).alias("good_lost"),
        total(removed & F.col("toxic")).alias("toxic_lost"),
        total(fails, n * share).alias("shapley"),
    )
    # 600 rows whatever the data, hence the hint.
    table = docs.sparkSession.createDataFrame(steps, "filter_order string, step int, bit int, before int")
    report = counts.join(F.broadcast(table), ["bit", "before"])
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return report.select("part", "filter_order", "step", *names)


#: The same audit from regular expressions, with one row per document and step.
ORACLE_SQL = """
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body FROM documents
), words AS (
  SELECT *, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words FROM texts
), first AS (
  SELECT body, min(doc_id) AS first_id FROM texts GROUP BY body
), known AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), flagged AS (
  SELECT w.part, coalesce(k.good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
    list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f
      WHEN 'A' THEN len(w.words) < 200
      WHEN 'B' THEN 100 * len(list_distinct(w.words)) < 50 * len(w.words)
      WHEN 'C' THEN 100 * length(regexp_replace(w.body, '[^A-Z]', '', 'g')) > 3 * length(w.body)
      WHEN 'D' THEN regexp_matches(w.body, '[#$%&*|]')
      ELSE coalesce(w.doc_id > x.first_id, false) END) AS failed
  FROM words w JOIN first x USING (body) LEFT JOIN known k ON k.doc_id = w.doc_id
), patterns AS (
  SELECT part, good, toxic, failed, count(*) AS n FROM flagged GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, filter_order[s] AS f,
    string_split(filter_order[1 : s - 1], '') AS before
  FROM orders, range(1, 6) t(s)
), tried AS (
  SELECT part, filter_order, step, f, n, good, toxic, len(failed) AS n_failed,
    list_contains(failed, f) AS fails, list_has_any(failed, before) AS earlier
  FROM patterns, steps
), audit AS (
  SELECT part, filter_order, step, f,
    sum(n) FILTER (NOT fails AND NOT earlier) AS kept,
    sum(n) FILTER (fails AND NOT earlier) AS removed,
    sum(n) FILTER (fails AND earlier) AS redundant,
    sum(n) FILTER (fails AND n_failed = 1) AS unique_fails,
    sum(n) FILTER (fails AND NOT earlier AND good = 1) AS good_lost,
    sum(n) FILTER (fails AND NOT earlier AND toxic = 1) AS toxic_lost
  FROM tried GROUP BY ALL
)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept,
  CAST(coalesce(removed, 0) AS BIGINT) AS removed, CAST(coalesce(redundant, 0) AS BIGINT) AS redundant,
  CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
  CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
  CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM audit
"""
