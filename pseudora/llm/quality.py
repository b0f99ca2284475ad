"""Quality classifier: a sparse ensemble of rules over text statistics.

Small boosted trees over the statistics of a bounded, labelled sample (``TRAIN_DOCS``, half of each
label) are taken apart: each path from a root is a conjunctive rule. A logistic lasso over the rules
keeps few of them. The kept rules become Spark column expressions over the statistics columns,
which a vectorized function computes in the scan from the whole text.

Defined results: a NULL or empty text has all statistics 0 and a score like any other; an empty
table gives no rows; without labels of both kinds every document scores the share of good labels
(about 1 if there are none). Labels, language, source and id never enter a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm import textvec
from pseudora.llm.labelled import held_out, labelled_sample
from pseudora.llm.packing import packed, unpacked

TRAIN_DOCS = 8000
TREES, DEPTH, CUTS = 24, 3, 24
LASSO = 1e-3
THRESHOLD = 0.3

STATISTICS = (
    "words",
    "word_length",
    "distinct_words",
    "repeated_next",
    "most_frequent",
    "distinct_pairs",
    "upper",
    "digits",
    "punctuation",
    "exclamation",
    "symbol_words",
    "lines",
    "sentence_ends",
)
_SCHEMA = ", ".join(f"{name} double" for name in STATISTICS)


def _byte_class(members: bytes) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(members)] = True
    return table


_UPPER = _byte_class(bytes(range(65, 91)))
_LETTER = _byte_class(bytes([*range(65, 91), *range(97, 123)]))
_DIGIT = _byte_class(b"0123456789")
_PUNCTUATION = _byte_class(bytes(c for c in range(33, 127) if not chr(c).isalnum()))
_ENDS = _byte_class(b".?!;:,")


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of ``STATISTICS`` per text, ratios but for the logarithm of the word count."""
    found = []
    for first, last in textvec.sub_batches(texts):
        batch = textvec.Words(texts[first:last])
        hashes = batch.hashes()
        totals = {
            name: np.concatenate([[0], np.cumsum(table[batch.raw])])
            for name, table in (("upper", _UPPER), ("letter", _LETTER), ("digit", _DIGIT), ("mark", _PUNCTUATION))
        }
        shout = np.concatenate([[0], np.cumsum(batch.raw == ord("!"))])
        lines = np.concatenate([[0], np.cumsum(batch.raw == ord("\n"))])
        marks = totals["mark"][batch.end] - totals["mark"][batch.start]
        symbols = np.concatenate([[0], np.cumsum(marks == batch.end - batch.start)])
        ended = np.concatenate([[0], np.cumsum(_ENDS[batch.raw[batch.end - 1]])]) if len(batch.end) else np.zeros(1)
        for a, b, start, end in zip(batch.first, batch.last, batch.text_start, batch.text_end, strict=True):
            n = b - a
            if not n:
                found.append(np.zeros(len(STATISTICS)))
                continue
            words = hashes[a:b]
            counts = np.unique(words, return_counts=True)[1]
            pairs = textvec.mixed(words[:-1]) ^ words[1:]
            spot = slice(start, end)
            size = max(1, end - start)
            letters = max(1, totals["letter"][end] - totals["letter"][start])
            found.append(
                np.array(
                    [
                        np.log1p(n),
                        (batch.end[a:b] - batch.start[a:b]).sum() / n,
                        len(counts) / n,
                        (words[1:] == words[:-1]).sum() / n,
                        counts.max() / n,
                        len(np.unique(pairs)) / max(1, n - 1),
                        (totals["upper"][end] - totals["upper"][start]) / letters,
                        (totals["digit"][end] - totals["digit"][start]) / size,
                        (totals["mark"][end] - totals["mark"][start]) / size,
                        (shout[spot.stop] - shout[spot.start]) / n,
                        (symbols[b] - symbols[a]) / n,
                        (lines[end] - lines[start]) / n,
                        (ended[b] - ended[a]) / n,
                    ]
                )
            )
    return np.array(found).reshape(-1, len(STATISTICS))


def _statistics_of(texts: pd.Series) -> pd.DataFrame:
    """Few texts at a time are held as bytes beside the batch."""
    values = texts.to_numpy()
    found = [np.empty((0, len(STATISTICS)))]
    for first, last in textvec.size_ranges([0 if t is None else len(t) for t in values]):
        found.append(statistics([b"" if t is None else t.encode() for t in values[first:last]]))
    return pd.DataFrame(np.concatenate(found), columns=list(STATISTICS))


def statistics_column(text: Column) -> Column:
    return F.pandas_udf(_statistics_of, _SCHEMA)(text)


Condition = tuple[int, bool, float]  # statistic, greater than, cut


@dataclass(frozen=True)
class RuleEnsemble:
    """Conjunctive rules over ``STATISTICS`` with logistic weights."""

    rules: tuple[tuple[Condition, ...], ...]
    weights: tuple[float, ...]
    intercept: float

    def score(self, stats: str) -> Column:
        """The ensemble as one Column over a struct of statistics."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            holds = F.lit(True)
            for at, above, cut in rule:
                value = F.col(stats)[STATISTICS[at]]
                holds = holds & ((value > cut) if above else (value <= cut))
            total = total + F.when(holds, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def _holds(x: np.ndarray, rule: tuple[Condition, ...]) -> np.ndarray:
    found = np.ones(len(x), dtype=bool)
    for at, above, cut in rule:
        found &= (x[:, at] > cut) if above else (x[:, at] <= cut)
    return found


def _tree_paths(x, target, cuts, path, depth, least):
    """Paths of a regression tree on ``target``, and its prediction for each row."""
    mean = target.mean()
    best, gain = None, 1e-9
    if depth and len(target) >= 2 * least:
        base = target.sum() ** 2 / len(target)
        for at in range(x.shape[1]):
            for cut in cuts[at]:
                above = x[:, at] > cut
                n = int(above.sum())
                if least <= n <= len(target) - least:
                    up = target[above].sum()
                    better = up**2 / n + (target.sum() - up) ** 2 / (len(target) - n) - base
                    if better > gain:
                        best, gain = (at, cut, above), better
    if best is None:
        return ([path] if path else []), np.full(len(target), mean)
    at, cut, above = best
    paths, fitted = ([path] if path else []), np.empty(len(target))
    for side in (False, True):
        rows = above == side
        more, part = _tree_paths(x[rows], target[rows], cuts, (*path, (at, side, float(cut))), depth - 1, least)
        paths += more
        fitted[rows] = part
    return paths, fitted


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = TREES, depth: int = DEPTH, lasso: float = LASSO) -> RuleEnsemble:
    """Boost trees on the logistic gradient, then a lasso logistic fit over their paths."""
    if len(np.unique(y)) < 2:
        share = y.mean() if len(y) else 1.0
        return RuleEnsemble((), (), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    cuts = [np.unique(np.quantile(x[:, k], np.linspace(0.01, 0.99, CUTS))) for k in range(x.shape[1])]
    least = max(5, len(y) // 400)
    margin, rules = np.zeros(len(y)), []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-margin))
        paths, fitted = _tree_paths(x, y - chance, cuts, (), depth, least)
        rules += paths
        margin += 2.0 * fitted
    rules = [rule for rule in dict.fromkeys(rules)]
    if not rules:  # too few documents, or all alike: nothing tells the labels apart
        return RuleEnsemble((), (), float(np.log(y.mean() / (1 - y.mean()))))
    design = np.stack([_holds(x, rule) for rule in rules], axis=1).astype(float)
    weights, intercept = _lasso(design, y.astype(float), lasso)
    kept = [k for k in range(len(rules)) if weights[k]]
    return RuleEnsemble(
        tuple(rules[k] for k in kept), tuple(float(weights[k]) for k in kept), float(intercept)
    )


def _lasso(design: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400):
    """Accelerated proximal gradient for the L1-penalized logistic loss; free intercept."""
    n = len(y)
    full = np.concatenate([design, np.ones((n, 1))], axis=1)
    step = 4 * n / np.linalg.norm(full, 2) ** 2
    w = np.zeros(full.shape[1])
    ahead, pace = w.copy(), 1.0
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-(full @ ahead)))
        new = ahead - step * (full.T @ (chance - y)) / n
        new[:-1] = np.sign(new[:-1]) * np.maximum(np.abs(new[:-1]) - step * penalty, 0)
        pace_next = (1 + np.sqrt(1 + 4 * pace**2)) / 2
        ahead = new + (pace - 1) / pace_next * (new - w)
        w, pace = new, pace_next
    return w[:-1], w[-1]


def train(docs: DataFrame, labels: DataFrame, *, limit: int = TRAIN_DOCS) -> RuleEnsemble:
    """Fit on at most ``limit`` labelled documents; only their statistics reach the driver.

    Of rows that repeat an id one is taken, that with the smallest statistics.
    """
    sample = F.broadcast(labelled_sample(labels, "quality", limit))
    rows = docs.select("doc_id", "text").join(sample, "doc_id")
    rows = rows.select("doc_id", "label", statistics_column(F.col("text")).alias("s"))
    rows = rows.groupBy("doc_id", "label").agg(F.min("s").alias("s")).collect()
    rows.sort(key=lambda r: (r["doc_id"], tuple(r["s"])))
    x = np.array([tuple(row["s"]) for row in rows]).reshape(-1, len(STATISTICS))
    return fit(x, np.array([row["label"] for row in rows]))


def score_quality(docs: DataFrame, model: RuleEnsemble, *, name: str = "score") -> DataFrame:
    """``docs`` with ``name``, the chance that a document is good, in place of a column so called."""
    rated = packed(docs, "text").withColumn("statistics", statistics_column(F.col("text")))
    return unpacked(rated, docs.columns, **{name: model.score("statistics")})


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_quality(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, *, threshold: float = THRESHOLD) -> DataFrame:
    """Drop documents that the classifier rejects."""
    rated = packed(docs, "text").withColumn("statistics", statistics_column(F.col("text")))
    good = rated.where(train(docs, labels).score("statistics") >= threshold)
    return unpacked(good, docs.columns)
