"""Secret scans behind a trigram filter, with DataFrame functions only.

Every rule's regex yields a Boolean query over trigrams that each match must contain, without
regard to case. A document's row of the trigram index, one bit for each trigram in use, is made in
the scan and evaluated there: postings that lead from trigrams to documents are not stored, as each
text is scanned once for a fixed set of rules. Only documents left by a rule's query are searched
with its regex; a rule without mandatory trigrams searches all. Nothing is shuffled.

Defined results: a NULL or empty text has no spans; overlapping spans of different rules are all
kept; an empty table gives no rows; repeated rows are scanned each for itself; other columns are
passed through untouched. Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import product
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm.packing import ROW, unpacked

_BITS = 60
_MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A regex (syntax common to Java and RE2); ``group`` must have ``least`` characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


# The base rules. A run of hex digits or of key characters is taken whole by its
# regex, so its least length can stand in the pattern.
BASE = (
    Rule(
        "assign",
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public token formats added to the base.
MORE = (
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE + MORE

Query = list[list[frozenset[str]]]


def _language(node) -> set[str] | None:
    """All strings of a regex node, lower case; None if they are too many."""
    kind, value = node
    if kind is sre.LITERAL:
        return {chr(value).lower()}
    if kind is sre.IN and all(item[0] is sre.LITERAL for item in value):
        return {chr(code).lower() for _, code in value}
    if kind is sre.SUBPATTERN:
        return _sequence_language(value[-1])
    if kind is sre.BRANCH:
        parts = [_sequence_language(option) for option in value[1]]
        return None if None in parts else set().union(*parts)
    if kind is sre.MAX_REPEAT and value[:2] == (0, 1):
        inner = _sequence_language(value[2])
        return None if inner is None else inner | {""}
    return None


def _sequence_language(nodes) -> set[str] | None:
    strings = {""}
    for node in nodes:
        part = _language(node)
        if part is None or len(part) * len(strings) > _MOST_STRINGS:
            return None
        strings = {a + b for a, b in product(strings, part)}
    return strings


def trigram_query(regex: str) -> Query:
    """AND of ORs of ANDs: each clause lists the trigram sets of which one must be present."""
    clauses, strings = [], {""}

    def close() -> None:
        sets = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
        if all(sets):
            least = [s for s in set(sets) if not any(other < s for other in sets)]
            clauses.append(sorted(least, key=sorted))

    for node in _parser.parse(regex):
        part = _language(node)
        if part is not None and len(part) * len(strings) <= _MOST_STRINGS:
            strings = {a + b for a, b in product(strings, part)}
            continue
        close()
        strings = part or {""}
    close()
    return clauses


def trigrams_of(rules) -> list[str]:
    found = {t for r in rules for clause in trigram_query(r.regex) for s in clause for t in s}
    return sorted(found)


def with_postings(docs: DataFrame, trigrams: list[str], text: str) -> DataFrame:
    """Add the posting bits of each trigram as long columns ``_postings<k>``."""
    lower = docs.withColumn("_lower", F.lower(F.col(text)))
    columns = {}
    for first in range(0, len(trigrams), _BITS):
        bits = F.lit(0).cast("long")
        for bit, trigram in enumerate(trigrams[first : first + _BITS]):
            hit = F.contains(F.col("_lower"), F.lit(trigram))
            bits = bits.bitwiseOR(F.when(hit, F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long")))
        columns[f"_postings{first // _BITS}"] = bits
    return lower.withColumns(columns).drop("_lower")


def candidate(rule: Rule, trigrams: list[str]) -> Column:
    """Whether a document is left after intersecting the rule's postings."""
    where = {trigram: divmod(spot, _BITS) for spot, trigram in enumerate(trigrams)}

    def all_present(grams: frozenset[str]) -> Column:
        masks: dict[int, int] = {}
        for gram in grams:
            word, bit = where[gram]
            masks[word] = masks.get(word, 0) | 1 << bit
        present = F.lit(True)
        for word, mask in masks.items():
            wanted = F.lit(mask).cast("long")
            present = present & (F.col(f"_postings{word}").bitwiseAND(wanted) == wanted)
        return present

    left = F.lit(True)
    for clause in trigram_query(rule.regex):
        some = F.lit(False)
        for grams in clause:
            some = some | all_present(grams)
        left = left & some
    return left


_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"


def rule_spans(rule: Rule, rank: int, text: Column) -> Column:
    """Leftmost non-overlapping matches: the pieces between them give their offsets."""
    matches = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.regex), F.lit(rule.group))
    pieces = F.slice(F.split(text, rule.regex, -1), F.lit(1), F.size(matches))
    sizes = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m")))
    rows = F.zip_with(sizes, groups, lambda s, g: F.struct(s["p"].alias("p"), s["m"].alias("m"), F.length(g).alias("g")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("found"))

    def step(state, row):
        begin = state["at"] + row["p"]
        span = F.struct(
            begin.alias("start"), F.lit(rank).alias("rank"), (begin + row["m"]).alias("end"), F.lit(rule.kind).alias("kind")
        )
        kept = F.when(row["g"] >= rule.least, F.array(span)).otherwise(F.array().cast(_SPANS))
        return F.struct((begin + row["m"]).alias("at"), F.concat(state["found"], kept).alias("found"))

    return F.aggregate(rows, start, step, lambda state: state["found"])


def find_secrets(docs: DataFrame, *, rules=RULES, text: str = "text", name: str = "secrets") -> DataFrame:
    """Add ``name``: array of (start, rank, end, kind), ordered by start and then rule order.

    It takes the place of a column so called.
    """
    return unpacked(_with_spans(docs, rules, text), docs.columns, **{name: F.col("spans")})


def _with_spans(docs: DataFrame, rules, text: str) -> DataFrame:
    """Packed rows with their ``text`` and ``spans``."""
    trigrams = trigrams_of(rules)
    none = F.array().cast(_SPANS)
    texts = docs.select(F.struct("*").alias(ROW), F.col(text).alias("text"))
    indexed = with_postings(texts, trigrams, "text")
    found = {}
    for rank, rule in enumerate(rules):
        query = candidate(rule, trigrams) & F.col("text").rlike(rule.regex)
        found[f"_found{rank}"] = F.when(query, rule_spans(rule, rank, F.col("text"))).otherwise(none)
    spans = F.array_sort(F.concat(*(F.col(c) for c in found)))
    return indexed.withColumns(found).select(ROW, "text", spans.alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, *, rules=RULES, mark: str = "[SECRET]") -> DataFrame:
    """Replace every span in ``text`` by ``mark``; other documents stay as they are."""
    found = _with_spans(docs, rules, "text")
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(state, span):
        upto = F.greatest(span["start"] - state["at"], F.lit(0))
        before = F.substr(F.col("text"), state["at"] + 1, upto)
        fresh = F.concat(state["out"], before, F.lit(mark))
        # A span that begins inside the one before only moves the end.
        out = F.when(span["start"] < state["at"], state["out"]).otherwise(fresh)
        return F.struct(F.greatest(span["end"], state["at"]).alias("at"), out.alias("out"))

    clean = F.aggregate(
        F.col("spans"), start, step, lambda s: F.concat(s["out"], F.substr(F.col("text"), s["at"] + 1))
    )
    return unpacked(found, docs.columns, text=F.when(F.size("spans") > 0, clean).otherwise(F.col("text")))


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, spans per base kind, digest of the base spans, all spans as text."""
    found = find_secrets(docs.select("doc_id", "text"))
    base = F.filter("secrets", lambda s: s["rank"] < len(BASE))

    def count(rank: int) -> Column:
        return F.size(F.filter("secrets", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(rank).alias(f"n_{rule.kind}") for rank, rule in enumerate(BASE)]
    return found.select(
        "doc_id",
        *counts,
        F.sha2(span_text(base), 256).alias("base_sha256"),
        span_text(F.col("secrets")).alias("spans"),
    )


def _oracle() -> str:
    lists = []
    for rank, rule in enumerate(RULES):
        regex = rule.regex.replace("'", "''")
        lists.append(
            f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, '{regex}')) + 1), lambda i: {{
              's': coalesce(list_sum(list_transform(string_split_regex(t, '{regex}')[1:i], lambda x: length(x))), 0)::BIGINT
                 + coalesce(list_sum(list_transform(regexp_extract_all(t, '{regex}')[1:i-1], lambda x: length(x))), 0)::BIGINT,
              'k': {rank},
              'm': length(regexp_extract_all(t, '{regex}')[i]),
              'g': length(regexp_extract_all(t, '{regex}', {rule.group})[i]),
              'n': '{rule.kind}'}}), lambda x: x.g >= {rule.least})"""
        )
    columns = ", ".join(f"{found} AS l{rank}" for rank, found in enumerate(lists))
    text = "array_to_string(list_transform(list_sort(flatten([{}])), lambda x: x.n || ':' || x.s || ':' || (x.s + x.m)), ',')"
    counts = ", ".join(f"len(l{rank})::BIGINT AS n_{rule.kind}" for rank, rule in enumerate(BASE))
    every = ", ".join(f"l{rank}" for rank in range(len(RULES)))
    return f"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    f AS MATERIALIZED (SELECT doc_id, {columns} FROM d)
    SELECT doc_id, {counts}, sha256({text.format("l0, l1, l2")}) AS base_sha256, {text.format(every)} AS spans
    FROM f"""


ORACLE_SQL = _oracle()
