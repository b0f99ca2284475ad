"""Benchmark decontamination by a hash set of normalised n-grams, with DataFrame functions only.

The benchmark's distinct windows (13 words; a shorter item is one window) are measured and, if
small, broadcast as a hash set. Each document's windows are hashed in the scan, probed one by
one, and every hit is verified word by word. A benchmark too large to broadcast takes a shuffled
join of the hashes instead, verified by a second, independent 64-bit hash; results are the same.

What was found is keyed by the text's SHA-256, so copies of a text count once, whatever their
number, and rows with equal or NULL ids are judged each by their own text. Texts never move: rows
with an item's words are few, and their keys, counted first, are broadcast to the documents; only
beyond ``MAX_FOUND`` of them are the documents' keys shuffled, those of many copies cut.

Defined results: a NULL or empty text has no words and is clean; items without words and items
with a NULL id give no windows; repeated items count once by id; an empty benchmark hits nothing;
other columns are passed through untouched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm.packing import ROW, packed, unpacked, without
from pseudora.llm.store import stored
from pseudora.plans.skew import spread_left_join

WINDOW = 13
HIT_PERCENT = 5
MAX_WINDOWS, MAX_CHARS = 300_000, 64_000_000
MAX_FOUND = 200_000
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ and the same with A-Z, written with few ranges: Java tests the union of several
#: by calls nested in each other, three times slower on one thread and 12 to 15 times where six share a JVM.
WORD = r"[0-9a-z[^\p{ASCII}]]+"
WORD_ANY_CASE = r"[\p{Alnum}[^\p{ASCII}]]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; texts without other letters take the faster function."""
    plain = F.length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _hashes(words: str, length: int) -> Column:
    """Hashes of all windows of ``length`` words, in order."""
    count = F.size(words) - length + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(F.col(words), i, F.lit(length))))


def benchmark_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct windows: (length, hash, second hash, words, items that hold it)."""
    items = benchmark.where(F.col("item_id").isNotNull()).select(
        "item_id", words_of(F.col("text")).alias("_words")
    )
    length = F.least(F.size("_words"), F.lit(window))
    starts = F.explode(F.sequence(F.lit(1), F.size("_words") - F.col("_length") + 1))
    cut = (
        items.where(F.size("_words") > 0)
        .withColumn("_length", length)
        .withColumn("_at", starts)
        .select("item_id", "_length", F.slice("_words", F.col("_at"), F.col("_length")).alias("_window"))
    )
    return (
        cut.groupBy("_length", "_window")
        .agg(F.collect_set("item_id").alias("_items"))
        .withColumns({"_hash": F.xxhash64("_window"), "_check": F.xxhash64(F.lit(1), F.col("_window"))})
    )


def matches(
    docs: DataFrame, benchmark: DataFrame, *, window: int = WINDOW, max_windows: int = MAX_WINDOWS
) -> DataFrame:
    """Verified hits per distinct text: (_key, n_hit, item ids, n_words)."""
    windows = benchmark_windows(benchmark, window)
    size = windows.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.length(F.array_join("_window", " "))), F.lit(0)).alias("chars"),
        F.coalesce(F.sum(F.size("_items")), F.lit(0)).alias("items"),
        F.collect_set("_length").alias("lengths"),  # 13 values at most
    ).first()
    texts = docs.select(F.sha2("text", 256).alias("_key"), words_of(F.col("text")).alias("_words"))
    lists = F.array(
        *(F.struct(F.lit(n).alias("_length"), _hashes("_words", n).alias("_hashes")) for n in sorted(size["lengths"]) or [window])
    )
    texts = texts.select("_key", "_words", F.inline(lists))
    count = F.size("_words").alias("_count")
    probes = texts.select("_key", "_words", count, "_length", F.posexplode("_hashes").alias("_at", "_hash"))
    if max(size["rows"], size["items"]) <= max_windows and size["chars"] <= MAX_CHARS:
        found = probes.join(F.broadcast(windows.drop("_check")), ["_length", "_hash"])
        own = F.slice("_words", F.col("_at") + 1, F.col("_length"))
        # Two inequalities: an equality would become a join key and be computed for every window.
        found = found.where((own <= F.col("_window")) & (own >= F.col("_window")))
    else:
        own = F.slice("_words", F.col("_at") + 1, F.col("_length"))
        probes = probes.select("_key", "_count", "_length", "_at", "_hash", F.xxhash64(F.lit(1), own).alias("_check"))
        found = probes.join(windows.drop("_window"), ["_length", "_hash", "_check"])
    span = F.struct("_at", (F.col("_at") + F.col("_length")).alias("end"))
    hits = found.select("_key", "_count", span.alias("_span"), "_items")
    return hits.groupBy("_key").agg(
        F.first("_count").cast("long").alias("n_words"),
        _covered(F.array_sort(F.collect_set("_span"))).alias("n_hit"),
        F.array_distinct(F.flatten(F.collect_set("_items"))).alias("_item_ids"),
    )


def _covered(spans: Column) -> Column:
    """Words inside the union of sorted spans."""
    start = F.struct(F.lit(0).alias("reach"), F.lit(0).cast("long").alias("words"))

    def step(state, span):
        fresh = span["end"] - F.greatest(span["_at"], state["reach"])
        return F.struct(
            F.greatest(state["reach"], span["end"]).alias("reach"),
            (state["words"] + F.greatest(fresh, F.lit(0))).alias("words"),
        )

    return F.aggregate(spans, start, step, lambda state: state["words"])


def _contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (n_hit * (100 // HIT_PERCENT) >= n_words)


def judged(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    window: int = WINDOW,
    max_windows: int = MAX_WINDOWS,
    max_found: int = MAX_FOUND,
) -> DataFrame:
    """``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated.

    They take the place of columns so called. ``docs`` comes straight from storage.
    """
    ids = F.array_sort(F.transform("_item_ids", lambda i: i.cast("string")))
    found = matches(docs, benchmark, window=window, max_windows=max_windows).select(
        "_key", "n_hit", F.size("_item_ids").cast("long").alias("n_items"), F.array_join(ids, ",").alias("items")
    )
    found = stored(found, "hits")
    keyed = packed(docs).withColumns(
        {
            "_key": F.sha2(F.col(ROW)["text"], 256),
            "n_words": F.coalesce(F.regexp_count(F.col(ROW)["text"], F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long"),
        }
    )
    if found.count() <= max_found:
        joined = keyed.join(F.broadcast(found), "_key", "left")
    else:
        joined = spread_left_join(keyed, ["_key"], unique=[found])
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return unpacked(
        joined,
        docs.columns,
        n_words=F.col("n_words"),
        n_hit=n_hit,
        n_items=F.coalesce("n_items", F.lit(0).cast("long")),
        items_sha256=F.sha2(F.coalesce("items", F.lit("")), 256),
        contaminated=_contaminated(n_hit, F.col("n_words")),
    )


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    small = judged(docs.select("doc_id", "text"), benchmark)
    return small.drop("text")


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, *, max_found: int = MAX_FOUND) -> DataFrame:
    """Drop contaminated documents; the others stay as they are.

    Keys of contaminated texts meet the documents in an anti join, as a broadcast set if they are
    few.
    """
    text = docs.select("text").where(F.col("text").isNotNull())
    found = matches(text, benchmark).where(_contaminated(F.col("n_hit"), F.col("n_words")))
    keyed = packed(docs).withColumn("_key", F.sha2(F.col(ROW)["text"], 256))
    return unpacked(without(keyed, found.select("_key"), "_key", max_found), docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
i AS (
  SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p
        FROM b WHERE len(w) > 0)),
g AS (
  SELECT r, p, n, array_to_string(w[p:p + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS p
        FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n)),
m AS (SELECT g.r, g.p, g.n, i.item_id FROM g JOIN i USING (n, g)),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM m) GROUP BY r),
s AS (SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
      FROM (SELECT DISTINCT r, item_id FROM m) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  (coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w)) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)
"""
