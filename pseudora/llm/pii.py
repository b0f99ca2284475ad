"""Personal data: base patterns, and identifiers found by bootstrapped contexts.

One scan extracts, per document, the base spans, and candidates: tokens rich in digits that no base
span touches, and groups with digits joined over blanks, dots, slashes and brackets. Each carries its
lexical pattern, the two whole tokens before it. Texts are cut into
tokens by one rule, here and where patterns are counted: a word or number ends where a value may
begin, marks such as ``:`` or ``(`` stay with the word they follow, so a label means the same glued to
its value and apart from it. Seeds (base entities) induce
patterns; Spark scores the pattern-instance graph over ``ROUNDS`` rounds: a pattern is as good as
the confidence of its instances, measured against all its occurrences in the corpus; an instance is
believed if it is met by good patterns; believed instances support further patterns. Candidates
that end above ``BELIEVED`` are added as spans of kind ``found``, wherever they stand.

Whatever else follows a pattern that ends above ``BELIEVED``, a word, a few digits or a mail address
written with (at) and (dot), is judged after the rounds: it is found there if at least that share of all
its occurrences in the corpus follow such patterns, so common words and numbers are left alone.

The first scan stores spans only, so rounds work on a small table; the corpus is read again to count
the patterns, and twice more if patterns are good, for what follows them; sets of patterns and values
are broadcast if small and joined otherwise. Counts are
combined before every shuffle, whatever the size of a group of copies.

Defined results: a NULL or empty text has no spans; base spans of different kinds may overlap and
are all kept; an empty table gives no rows; repeated rows are scanned each for itself, while
copies of one instance count once for a pattern. Of joined groups the whole is found, else those parts
that are believed; a longer word may be found around a number that is found too. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm.store import dropped, stored

KINDS = ("email", "ip", "card", "phone", "found")
ROUNDS, BELIEVED, PRIOR, LEAST_SEEDS = 3, 0.6, 2.0, 3
CANDIDATE_DIGITS = 5
BROADCAST_PATTERNS, BROADCAST_CHARS = 100_000, 16_000_000
FEW = 50  # so few patterns or words are looked for in a text as they are, before it is cut into tokens

# The base patterns.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")  # a run of digits is tried once
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_RUN = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-")
_FROM_DIGIT = re.compile(r"[0-9][A-Za-z0-9-]*")
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    total = 0
    for at, char in enumerate(reversed(digits)):
        value = int(char) * (1 + at % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Found from each @ outwards, which is linear in the text however long a word is."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at)
        if match and start < at:
            done = match.end()
            yield start, done
        else:
            done = at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[Span]:
    """Spans by kind as listed, then start."""
    found: list[Span] = [(0, a, b) for a, b in _emails(text)]
    for match in _IP.finditer(text):
        parts = match.group().split(".")
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in parts):
            found.append((1, *match.span()))
    for match in _CARD.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append((2, *match.span()))
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 8 <= len(_DIGIT.findall(match.group())) <= 15:
                found.append((3, *match.span()))
    return found


_TOKEN = re.compile(r"(?:[^\W\d_]+(?:[._'-][^\W\d_]+)*|\d+|[._%+-])[^\w\s.%+-]*|[^\w\s.%+-]+|\w")


def flat(text: str) -> str:
    """In lower case, digits made equal, every character at its place."""
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    for digit in "123456789":
        lower = lower.replace(digit, "0")
    return lower


def _tokens(text: str) -> tuple[list[str], list[int]]:
    """The tokens of a text and where they end."""
    low = flat(text)
    words = _TOKEN.findall(low)
    return words, _ends(low, words)


def _ends(text: str, words: list[str]) -> list[int]:
    """Where words end that follow one another with nothing between them that a word begins with."""
    ends, at = [], 0
    for word in words:
        at = text.index(word, at) + len(word)
        ends.append(at)
    return ends


def _before(tokens: tuple[list[str], list[int]], start: int) -> str:
    """The two whole tokens before a position, however long they are."""
    words, ends = tokens
    last = bisect_right(ends, start)
    return " ".join(words[max(0, last - 2) : last])


class _Cover:
    """The union of spans, asked by bisection."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start <= self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def touches(self, start: int, end: int) -> bool:
        """Whether a place from ``start`` to ``end`` is covered; ``end`` is exclusive."""
        last = bisect_left(self.starts, end)
        return last > 0 and self.ends[last - 1] > start


def _runs(text: str, taken: list[Span]) -> Iterator[tuple[int, int]]:
    """Whole runs of letters, digits and hyphens that hold a digit and that no base span touches."""
    done, cover = 0, _Cover([(start, end) for _, start, end in taken])
    for match in _FROM_DIGIT.finditer(text):
        a, b = match.span()
        while a > done and text[a - 1] in _RUN:
            a -= 1
        done = b
        if not cover.touches(a, b):
            yield a, b


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, int, int]]:
    """(start, end, start and end of the joined groups around it): many digits, no base span."""
    found, group = [], []

    def close() -> None:
        if not group:
            return
        a, b = group[0][0], group[-1][1]
        if ")" in text[a:b]:
            a -= 1
        if len(group) > 1 and len(_DIGIT.findall(text, a, b)) >= CANDIDATE_DIGITS:
            found.append((a, b, a, b))
        for start, end in group:
            if len(_DIGIT.findall(text, start, end)) >= CANDIDATE_DIGITS:
                found.append((start, end, a, b))

    for a, b in _runs(text, taken):
        gap = text[group[-1][1] : a] if group else ""
        opened = len(group) == 1 and text[group[0][0] - 1 : group[0][0]] == "("
        if not (gap in _JOINS or (opened and gap in _CLOSES)):
            close()
            group = []
        group.append((a, b))
    close()
    return found


_JOINS, _CLOSES = frozenset((" ", "\xa0", ".", "/")), frozenset((")", ") ", ")\xa0"))
_ROW = "kind int, start int, end int, pattern string, value string, whole string"


def _extract(texts: pd.Series) -> pd.Series:
    rows = []
    for text in texts:
        text = text or ""
        base = base_spans(text)
        more = candidates(text, base)
        tokens = _tokens(text) if base or more else ([], [])
        found = [(k, a, b, _before(tokens, a), text[a:b], None) for k, a, b in base]
        for a, b, first, last in more:
            part = (a, b) != (first, last)
            # The first part stands in the context of the whole, which counts once.
            pattern = "" if part and len(text[first:a]) < 2 else _before(tokens, a)
            found.append((4, a, b, pattern, text[a:b], text[first:last] if part else None))
        rows.append(found)
    return pd.Series(rows)


def extracted(docs: DataFrame) -> DataFrame:
    """(doc_id, row, digest, spans): stored, so that ``row`` names a row for good."""
    spans = F.pandas_udf(_extract, f"array<struct<{_ROW}>>")(F.col("text"))
    row = F.monotonically_increasing_id().alias("row")
    return stored(docs.select("doc_id", row, F.sha2("text", 256).alias("digest"), spans.alias("spans")), "spans")


# What stands after a pattern: a run of anything but blanks and the marks here, from its first to its last
# letter or digit, joined with further groups of digits or with masked parts of a mail address.
_MARKS = r"\s,;:!?()\[\]{}<>\"=#|*`"
_CORE = re.compile(rf"(?<![^{_MARKS}])(?:_|[^\w{_MARKS}])*([^\W_](?:[^{_MARKS}]*[^\W_])?)")
_NEXT = re.compile(r"\s*" + _CORE.pattern)
_GROUPS = re.compile(r"(?:[\x20\xa0][A-Za-z-]*[0-9][A-Za-z0-9-]*){1,4}")
_MASKED = re.compile(rf"(?:\s?[\[({{<](?:at|dot|@|\.)[\])}}>]\s?[^{_MARKS}]*[^\W_])+", re.IGNORECASE)


def _until(text: str, core: str, end: int) -> int:
    more = _MASKED.match(text, end) or (_DIGIT.search(core) and _GROUPS.match(text, end))
    return more.end() if more else end


def _table(name: str, counts: Counter[str]) -> pd.DataFrame:
    return pd.DataFrame({name: pd.Series(list(counts), dtype=object), "n": pd.Series(list(counts.values()), dtype="int64")})


def _following(good):
    """What follows the good patterns, or any pattern if they were not broadcast."""

    def run(texts: pd.Series) -> pd.Series:
        only = good.value if good is not None else None
        few = [pattern.split(" ") for pattern in only] if only is not None and len(only) <= FEW else None
        rows = []
        for text in texts:
            text = text or ""
            low = flat(text)
            if few is not None and not any(a in low and b in low for a, b in few):
                rows.append([])
                continue
            words = _TOKEN.findall(low)
            runs = enumerate(map(" ".join, zip(words, words[1:], strict=False)), 1)
            hits = [(at, pattern) for at, pattern in runs if only is None or pattern in only]
            if not hits:
                rows.append([])
                continue
            ends = _ends(low, words)
            tokens = words, ends
            base = base_spans(text)
            found_before = _Cover([(a, b) for a, b, *_ in candidates(text, base)])
            cover = _Cover([(a, b) for _, a, b in base])
            found = []
            for at, pattern in hits:
                core = _NEXT.match(text, ends[at])
                if core is None or _before(tokens, core.start(1)) != pattern:
                    continue
                a, b = core.start(1), _until(text, core[1], core.end(1))
                if not cover.touches(a, b) and not found_before.touches(a, a + 1):
                    found.append((a, b, pattern, text[a:b]))
            rows.append(found)
        return pd.Series(rows)

    return run


def _standing(wanted):
    """Count what may follow a pattern, wherever it stands; only wanted values if they were broadcast."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only = wanted.value if wanted is not None else None
        heads = None if only is None else {_CORE.match(value)[1] for value in only}
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch["text"]:
                text = text or ""
                if heads is not None and len(heads) <= FEW and not any(head in text for head in heads):
                    continue
                cores = _CORE.findall(text)
                if heads is not None and heads.isdisjoint(cores):
                    continue
                for core, end in zip(cores, _ends(text, cores), strict=True):
                    if heads is None or core in heads:
                        counts[text[end - len(core) : _until(text, core, end)]] += 1
            if only is not None:
                counts = Counter({value: n for value, n in counts.items() if value in only})
            yield _table("value", counts)

    return run


def _shared(df: DataFrame, name: str, most: int):
    """The values of a column as a broadcast set, or None if there are too many or they are too long."""
    chars = F.coalesce(F.sum(F.length(name)), F.lit(0)).alias("chars")
    size = df.agg(F.count(F.lit(1)).alias("rows"), chars).first()
    if size["rows"] > most or size["chars"] > BROADCAST_CHARS:
        return None
    return df.sparkSession.sparkContext.broadcast({row[name] for row in df.select(name).collect()})


def followers(docs: DataFrame, scores: DataFrame, most: int = BROADCAST_PATTERNS) -> DataFrame:
    """(doc_id, digest, start, end) of words and short numbers that mostly follow good patterns."""
    good = stored(scores.where(F.col("score") >= BELIEVED).select("pattern"), "good")
    udf = F.pandas_udf(_following(patterns := _shared(good, "pattern", most)), "array<struct<start int, end int, pattern string, value string>>")
    spans = docs.select("doc_id", F.sha2("text", 256).alias("digest"), F.explode(udf("text")).alias("s")).select("doc_id", "digest", "s.*")
    if patterns is None:
        spans = spans.join(good, "pattern", "left_semi")
    spans = stored(spans, "followers")
    if patterns is not None:
        patterns.unpersist()
    hits = stored(spans.groupBy("value").agg(F.count(F.lit(1)).alias("hits")), "hits")
    values = _shared(hits, "value", most)
    counted = docs.select("text").mapInPandas(_standing(values), "value string, n long")
    if values is None:
        counted = counted.join(hits.select("value"), "value", "left_semi")
    sure = hits.join(counted.groupBy("value").agg(F.sum("n").alias("n")), "value")
    sure = sure.where(F.col("hits") >= BELIEVED * F.col("n")).select("value")
    return spans.join(sure, "value", "left_semi").select("doc_id", "digest", "start", "end").distinct()


def _occurrences(wanted):
    """Count runs of two tokens of whole texts; only the wanted ones if they were broadcast."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        only = wanted.value if wanted is not None else None
        for batch in batches:
            counts: Counter[str] = Counter()
            for text in batch["text"]:
                words = _TOKEN.findall(flat(text or ""))
                runs = map(" ".join, zip(words, words[1:], strict=False))
                counts.update(runs if only is None else filter(only.__contains__, runs))
            yield _table("pattern", counts)

    return run


def pattern_totals(docs: DataFrame, patterns: DataFrame, most: int = BROADCAST_PATTERNS) -> DataFrame:
    """Occurrences of each pattern in the corpus, whatever follows it."""
    wanted = _shared(patterns, "pattern", most)
    counted = docs.select("text").mapInPandas(_occurrences(wanted), "pattern string, n long")
    if wanted is None:
        counted = counted.join(patterns.select("pattern"), "pattern", "left_semi")
    return counted.groupBy("pattern").agg(F.sum("n").alias("occurrences"))


def believed(docs: DataFrame, spans: DataFrame, *, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame] | None:
    """Values of candidates that the pattern-instance graph confirms, and the last (pattern, score)."""
    edges = spans.select(F.explode("spans").alias("s")).select("s.pattern", "s.value", (F.col("s.kind") < 4).alias("seed"))
    edges = edges.where("pattern LIKE '% %'").groupBy("pattern", "value", "seed").agg(F.count(F.lit(1)).alias("n"))
    edges = stored(edges, "edges")
    hopeful = edges.where("seed").groupBy("pattern").agg(F.count(F.lit(1)).alias("seeds"))
    hopeful = stored(hopeful.where(F.col("seeds") >= LEAST_SEEDS), "patterns")
    if not hopeful.limit(1).count():
        return None
    # Only patterns that meet a candidate, now or in a later round, or have seeds need their totals.
    linked = edges.where("NOT seed").select("pattern").union(hopeful.select("pattern")).distinct()
    totals = stored(pattern_totals(docs, stored(linked, "linked")), "totals")
    instances = stored(
        edges.select("value", F.col("seed").cast("double").alias("trust")).groupBy("value").agg(F.max("trust").alias("trust")),
        "instances",
    )
    scores = None
    for _ in range(rounds):
        good = edges.join(instances, "value").groupBy("pattern").agg(
            F.sum(F.col("trust") * F.col("n")).alias("good"),
            F.sum(F.when(F.col("trust") >= BELIEVED, 1).otherwise(0)).alias("support"),
        )
        scored = good.where(F.col("support") >= LEAST_SEEDS).join(totals, "pattern")
        score = F.least(F.lit(1.0), F.col("good") / (F.col("occurrences") + PRIOR))
        scores = stored(scored.select("pattern", score.alias("score")), "scores")
        # Belief in one instance grows with each good pattern: 1 - product(1 - score).
        doubt = F.exp(F.sum(F.log(F.greatest(1 - F.col("score"), F.lit(1e-6)))))
        gained = edges.where("NOT seed").select("pattern", "value").join(scores, "pattern")
        gained = gained.groupBy("value").agg((1 - doubt).alias("gained"))
        after = instances.join(gained, "value", "left").select(
            "value", F.greatest("trust", F.coalesce("gained", F.lit(0.0))).alias("trust")
        )
        after = stored(after, "instances")
        dropped(instances)
        instances = after
    found = edges.where("NOT seed").select("value").distinct()
    return instances.where(F.col("trust") >= BELIEVED).join(found, "value", "left_semi").select("value"), scores


def find_pii(docs: DataFrame, *, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, spans): base spans and confirmed candidates, by kind and start."""
    plain = docs.select("doc_id", "text")
    spans = extracted(plain)
    base = F.transform(F.filter("spans", lambda s: s["kind"] < 4), lambda s: F.struct(s["kind"], s["start"], s["end"]))
    none = F.array().cast("array<struct<kind:int,start:int,end:int>>")
    base = base.cast("array<struct<kind:int,start:int,end:int>>")
    known = believed(plain, spans, rounds=rounds)
    if known is None:
        return spans.select("doc_id", F.array_sort(base).alias("spans"))
    sure, scores = known
    maybe = spans.select("row", F.explode(F.filter("spans", lambda s: s["kind"] == 4)).alias("s"))
    maybe = maybe.select("row", "s.*").join(sure, "value", "left_semi")
    wholes = sure.select(F.col("value").alias("whole"))
    found = maybe.join(wholes, "whole", "left_anti").select("row", "kind", "start", "end")
    words = followers(plain, scores).groupBy("doc_id", "digest")
    words = words.agg(F.collect_list(F.struct(F.lit(4).alias("kind"), "start", "end")).alias("words"))
    words = words.select(F.col("doc_id").alias("_doc"), F.col("digest").alias("_digest"), "words")
    found = found.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end")).alias("more"))
    same = F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("digest") == F.col("_digest"))
    joined = spans.join(found, "row", "left").join(words, same, "left")
    every = F.array_sort(F.concat(base, F.coalesce("more", none), F.coalesce("words", none)))
    return joined.select("doc_id", every.alias("spans"))


def span_text(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return F.array_join(parts, ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """doc_id, spans per base kind, digest of the base spans, all spans as text."""

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(kind).alias(f"n_{name}") for kind, name in enumerate(KINDS[:4])]
    base = F.filter("spans", lambda s: s["kind"] < 4)
    return find_pii(docs).select(
        "doc_id", *counts, F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )
