"""URL filter: fixed host and path rules, else logistic regression on hashed character n-grams.

The model is trained on a small labelled URL table: by default distinct URLs that a rule decides,
at most ``TRAIN_URLS`` of them (a documented bound), taken in hash order. Features are the presence
of character n-grams of host and path, hashed into ``BUCKETS``. The weights, a fixed-size array,
become one constant of the scoring expression: one scan, no shuffle, no Python on executors.

Defined results: a NULL URL or one without ``://`` has empty host and path, which no rule fits
and which the model judges; with no or one-sided training labels the model allows; an empty table
gives no rows; repeated rows are judged each for itself; other columns are not looked at.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096
GRAM_SIZES = (3, 4)
TRAIN_URLS = 3000
EPOCHS = 12
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self) -> Column:
        host = (F.col("host") == self.host) | F.endswith(F.col("host"), F.lit("." + self.host))
        return host & F.startswith(F.col("path"), F.lit(self.path))


# The rules of the contract.
RULES = (
    UrlRule("block", "net", "/"),
    UrlRule("allow", "example.net", "/en/"),
    UrlRule("block", "example.com", "/de/"),
    UrlRule("allow", "org", "/fr/"),
)


def with_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Add ``host`` (A-Z lower-cased) and ``path``, both empty where there is no ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.substr(F.col(url), at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return df.withColumns(
        {
            "host": F.translate(host, _UPPER, _LOWER),
            "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1),
        }
    )


def with_rule(df: DataFrame, rules: Sequence[UrlRule] = RULES) -> DataFrame:
    """Add ``rule``, the longest that fits, and its ``ruled`` verdict; both NULL if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        name = F.when(rule.fits(), rule.text).otherwise(name)
        verdict = F.when(rule.fits(), rule.verdict).otherwise(verdict)
    return df.withColumns({"rule": name, "ruled": verdict})


def _part_grams(part: str, size: int, buckets: int) -> Column:
    """Buckets of the ``size``-grams of one marked part; ``part`` salts the hash."""
    # Split once: a piece by its place in the text would be looked for from the start each time.
    marked = F.split(F.concat(F.lit("^"), F.col(part), F.lit("$")), "")
    count = F.size(marked) - size + 1
    starts = F.when(count > 0, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))

    def bucket(at: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(part), F.array_join(F.slice(marked, at, F.lit(size)), "")), F.lit(buckets)).cast("int")

    return F.transform(starts, bucket)


def grams(buckets: int = BUCKETS) -> Column:
    """Distinct hash buckets of the n-grams of host and path, which keep apart."""
    return F.array_distinct(
        F.concat(*(_part_grams(part, size, buckets) for part in ("host", "path") for size in GRAM_SIZES))
    )


def fit(labelled: DataFrame, *, buckets: int = BUCKETS, limit: int = TRAIN_URLS, epochs: int = EPOCHS) -> list[float]:
    """Weights (bias last) from rows (host, path, label): at most ``limit`` distinct ones.

    Logistic regression by stochastic gradient steps of falling size over this bounded table.
    """
    rows = labelled.groupBy("host", "path").agg(F.max("label").alias("label"))
    rows = rows.orderBy(F.xxhash64("host", "path"), "host", "path").limit(limit)
    sample = rows.select(grams(buckets).alias("g"), "label", "host", "path").collect()
    sample.sort(key=lambda r: (r["host"], r["path"]))
    weights = [0.0] * (buckets + 1)
    if len({row["label"] for row in sample}) < 2:
        return weights
    order = sorted(range(len(sample)), key=lambda i: (i * 2654435761) % 4294967296)
    for epoch in range(epochs):
        rate = 0.5 / (1 + epoch)
        for i in order:
            features, label = sample[i]["g"], sample[i]["label"]
            scale = 1.0 / math.sqrt(len(features) or 1)
            z = weights[-1] + scale * sum(weights[g] for g in features)
            error = label - 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, z))))
            weights[-1] += 0.1 * rate * error
            for g in features:
                weights[g] += rate * scale * error
    return weights


def probability(weights: list[float]) -> Column:
    """Chance that a URL is to be blocked, over columns ``host`` and ``path``."""
    table = F.from_json(F.lit(json.dumps(weights)), "array<double>")
    total = F.aggregate(F.col("_grams"), F.lit(0.0), lambda s, g: s + F.get(table, g))
    scale = F.sqrt(F.greatest(F.size("_grams"), F.lit(1)).cast("double"))
    return 1 / (1 + F.exp(-(F.lit(weights[-1]) + total / scale)))


def filter_urls(pages: DataFrame, *, rules: Sequence[UrlRule] = RULES, labelled: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, probability); ``labelled`` may bring own labels."""
    ruled = with_rule(with_parts(pages.select("page_id", "url")), rules)
    if labelled is None:
        labelled = ruled.where("ruled IS NOT NULL").select(
            "host", "path", (F.col("ruled") == "block").cast("int").alias("label")
        )
    weights = fit(labelled)
    scored = ruled.withColumn("_grams", F.when(F.col("ruled").isNull(), grams()))
    scored = scored.withColumn("probability", probability(weights))
    guess = F.when(F.col("probability") > 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", guess).alias("verdict"), "probability"
    )
