"""Toxicity: a support vector machine with a gapped subsequence kernel and Nyström landmarks.

The kernel of two words compares all subsequences of ``ORDER`` letters, each weighted by
``DECAY`` per skipped letter, so words with gaps or inserted characters stay close. Words are
marked at both ends, stripped of anything but letters and digits, and runs of spaced single letters
count as one word.

Only documents are labelled, so the words that carry a label are found first: on a bounded sample
(``TRAIN_DOCS``, half of each label) Spark counts words by label, and a greedy cover picks words
that explain toxic documents and hardly occur in others. They and frequent harmless words are the
landmarks; the machine is trained on them, on variants with one inserted letter, and on harmless
words. As the kernel is a dot product of subsequence features, the landmark expansion folds into
one table of feature weights. A document scores by its worst word.

Scoring is one scan of the whole text by a vectorized function; each distinct word is rated once per
worker while it is remembered. Only counts of words in the sample are shuffled.

Defined results: a NULL or empty text has no word and gets the lowest score; an empty table gives
no rows; without toxic labels every document gets the lowest score. Labels, language, source
and id never enter a score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pseudora.llm.labelled import held_out, labelled_sample
from pseudora.llm.store import dropped, stored

TRAIN_DOCS = 6000
ORDER, DECAY, REACH = 3, 0.6, 7
LETTERS = 64
LONGEST = 32
MOST_LANDMARKS, HARMLESS_LANDMARKS = 240, 60
CANDIDATE_WORDS, HARMLESS_WORDS = 3000, 4000
LOWEST = -1.0
_REMEMBERED = 400_000
_TOGETHER = 64  # texts whose words are rated at once
_SPACED = re.compile(r"(?<!\S)\S(?:\s\S){2,}(?!\S)")
_NOT_LETTER = re.compile(r"[\W_]+")


_TRIPLES: dict[int, tuple[np.ndarray, ...]] = {}


def _triples(length: int) -> tuple[np.ndarray, ...]:
    """Index triples i < j < k within reach, and the decay of each."""
    if length in _TRIPLES:
        return _TRIPLES[length]
    found = [
        (i, j, k)
        for i in range(length)
        for j in range(i + 1, length)
        for k in range(j + 1, min(length, i + REACH))
    ]
    i, j, k = np.array(found, dtype=np.int64).reshape(-1, 3).T
    return _TRIPLES.setdefault(length, (i, j, k, DECAY ** (k - i - 2.0)))


def normal_word(token: str) -> str:
    return token if token.isalnum() else _NOT_LETTER.sub("", token)


def _pieces(word: str) -> list[str]:
    """The word between end marks; longer words as overlapping parts that cover all of it."""
    if len(word) <= LONGEST:
        return [word]
    return [word[at : at + LONGEST] for at in range(0, len(word) - LONGEST // 2, LONGEST // 2)]


def _coded(words: list[str]) -> np.ndarray:
    """Letter codes of words of one length, with end marks; other letters share a few codes."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    codes = np.where((points >= 97) & (points <= 122), points - 96, 28 + points % 36)
    return np.pad(codes.reshape(len(words), -1), ((0, 0), (1, 1)), constant_values=27)


def _features(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j, k, decay = _triples(codes.shape[1])
    return (codes[:, i] * LETTERS + codes[:, j]) * LETTERS + codes[:, k], decay


def explicit(word: str) -> dict[int, float]:
    """The word's normalized subsequence features."""
    keys, decay = _features(_coded([word]))
    found: dict[int, float] = {}
    for key, value in zip(keys[0].tolist(), decay.tolist(), strict=True):
        found[key] = found.get(key, 0.0) + value
    size = sum(v * v for v in found.values()) ** 0.5 or 1.0
    return {key: value / size for key, value in found.items()}


def kernel(a: dict[int, float], b: dict[int, float]) -> float:
    if len(b) < len(a):
        a, b = b, a
    return sum(value * b.get(key, 0.0) for key, value in a.items())


@dataclass(frozen=True)
class WordModel:
    """Feature weights with a shift, and the slope and middle that turn margins into scores."""

    table: np.ndarray
    shift: float
    middle: float = 0.0
    slope: float = 4.0

    def margins(self, words: list[str]) -> np.ndarray:
        """Margin of each normalized word, at least ``LOWEST``."""
        result = np.full(len(words), LOWEST)
        by_length: dict[int, list[tuple[int, str]]] = {}
        for at, word in enumerate(words):
            for piece in _pieces(word):
                if piece:
                    by_length.setdefault(len(piece), []).append((at, piece))
        for listed in by_length.values():
            for first in range(0, len(listed), 4096):
                part = listed[first : first + 4096]
                keys, decay = _features(_coded([piece for _, piece in part]))
                if not keys.shape[1]:
                    continue
                dots = self.table[keys] @ decay
                # The norm is at least that of distinct features, which bounds the margin.
                close = np.flatnonzero(dots / np.sqrt((decay**2).sum()) + self.shift > LOWEST)
                # Equal features of a word add up before they are squared; all words at once.
                place = np.arange(len(close))[:, None] * LETTERS**ORDER
                found, where = np.unique(keys[close] + place, return_inverse=True)
                sums = np.bincount(where.ravel(), weights=np.tile(decay, len(close)), minlength=len(found))
                norms = np.bincount(found // LETTERS**ORDER, weights=sums**2, minlength=len(close))
                rows = np.array([at for at, _ in part], dtype=np.int64)[close]
                np.maximum.at(result, rows, dots[close] / np.sqrt(norms) + self.shift)
        return result

    def score(self, margin: Column) -> Column:
        return 1 / (1 + F.exp(-self.slope * (margin - self.middle)))


def tokens_of(text: str) -> set[str]:
    lower = text.lower()
    found = set(lower.split())
    found.update("".join(m.group().split()) for m in _SPACED.finditer(lower))
    return found


class _Worst:
    """Largest margin of a text's words; margins of words seen before are remembered."""

    def __init__(self, model: WordModel):
        self.model, self.known = model, {}

    def __call__(self, texts: list[str | None]) -> list[float]:
        result = []
        for first in range(0, len(texts), _TOGETHER):
            listed = [tokens_of(text or "") for text in texts[first : first + _TOGETHER]]
            every = set().union(*listed)
            fresh = list(every.difference(self.known))
            if len(self.known) + len(fresh) > _REMEMBERED:
                self.known, fresh = {}, list(every)
            margins = self.model.margins([normal_word(token) for token in fresh])
            self.known.update(zip(fresh, margins.tolist(), strict=True))
            result += [max((self.known[t] for t in tokens), default=LOWEST) for tokens in listed]
        return result


def worst_margin(model: WordModel, text: Column) -> Column:
    kept: dict[str, _Worst] = {}

    def run(texts: pd.Series) -> pd.Series:
        worst = kept.setdefault("worst", _Worst(model))
        return pd.Series(worst(list(texts)), dtype="float64")

    return F.pandas_udf(run, "double")(text)


def sample_words(sample: DataFrame) -> DataFrame:
    """(doc_id, label, word): distinct normalized words of each sampled document."""
    tokens = F.split(F.lower("text"), r"\s+")
    words = F.transform(tokens, lambda t: F.regexp_replace(t, r"[^\p{L}\p{N}]+", ""))
    listed = sample.select("doc_id", "label", F.explode(F.array_distinct(words)).alias("word"))
    return listed.where((F.length("word") > 2) & (F.length("word") <= LONGEST))


def greedy_cover(found: dict[str, set], least: int) -> list[str]:
    """Words in the order in which they explain most documents not explained before."""
    open_docs = set().union(*found.values()) if found else set()
    left, chosen = dict(found), []
    while left and len(chosen) < MOST_LANDMARKS:
        word = max(left, key=lambda w: (len(left[w] & open_docs), w))
        gain = left.pop(word) & open_docs
        if len(gain) < least:
            break
        chosen.append(word)
        open_docs -= gain
    return chosen


def _with_insertion(word: str) -> list[str]:
    return [word[:at] + letter + word[at:] for at in range(1, len(word)) for letter in "aex"]


def fit_words(toxic: list[str], harmless: list[str]) -> WordModel:
    """Squared-hinge machine on Nyström features, folded into one table of feature weights."""
    marks = toxic + harmless[:HARMLESS_LANDMARKS]
    landmarks = [explicit(word) for word in marks]
    positive = toxic + [v for word in toxic for v in _with_insertion(word)]
    words = [explicit(word) for word in positive + harmless]
    y = np.array([1.0] * len(positive) + [-1.0] * len(harmless))
    # Rows of kernel values through one dense table of landmark features.
    used = {key: at for at, key in enumerate(sorted({k for mark in landmarks for k in mark}))}
    dense = np.zeros((len(marks), len(used)))
    for row, mark in enumerate(landmarks):
        dense[row, [used[k] for k in mark]] = list(mark.values())
    rows = np.zeros((len(words), len(marks)))
    for at, word in enumerate(words):
        keys = [(used[k], v) for k, v in word.items() if k in used]
        if keys:
            spots, values = zip(*keys, strict=True)
            rows[at] = dense[:, list(spots)] @ np.array(values)
    values, vectors = np.linalg.eigh(dense @ dense.T)
    root = vectors / np.sqrt(np.maximum(values, 1e-6)) @ vectors.T  # inverse square root
    z = np.concatenate([rows @ root, np.ones((len(words), 1))], axis=1)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    w, penalty = np.zeros(z.shape[1]), 1e-3
    step = 1 / (2 * np.linalg.norm(z * np.sqrt(weight)[:, None], 2) ** 2 + penalty)
    ahead, before = w.copy(), w
    for k in range(600):
        slack = np.maximum(0, 1 - y * (z @ ahead))
        w = ahead + step * (2 * z.T @ (weight * y * slack) - penalty * ahead)
        ahead = w + k / (k + 3) * (w - before)
        before = w
    table = np.zeros(LETTERS**ORDER)
    table[list(used)] = (root @ w[:-1]) @ dense
    return WordModel(table.astype(np.float32).astype(np.float64), float(w[-1]))


def _middle(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Cut with the fewest errors, in the widest gap among such cuts, and that gap."""
    order = np.argsort(margins, kind="stable")
    m, labels = margins[order], y[order]
    missed = np.concatenate([[0], np.cumsum(labels)])  # toxic documents below the cut
    false = np.concatenate([[0], np.cumsum((1 - labels)[::-1])])[::-1]
    edges = np.concatenate([[m[0] - 1], m, [m[-1] + 1]])
    gaps = np.diff(edges)
    errors = np.where(gaps > 0, missed + false, np.inf)
    at = max(np.flatnonzero(errors == errors.min()), key=lambda k: gaps[k])
    return float((edges[at] + edges[at + 1]) / 2), float(gaps[at])


def train(docs: DataFrame, labels: DataFrame, *, limit: int = TRAIN_DOCS) -> WordModel:
    """Fit on at most ``limit`` labelled documents; words and margins reach the driver.

    Of rows that repeat an id one is taken, that with the smallest text.
    """
    nothing = WordModel(np.zeros(LETTERS**ORDER), LOWEST)
    ids = F.broadcast(labelled_sample(labels, "toxic", limit))
    sample = docs.select("doc_id", "text").join(ids, "doc_id")
    sample = stored(sample.groupBy("doc_id", "label").agg(F.min("text").alias("text")), "sample")
    words = sample_words(sample)
    counts = stored(
        words.groupBy("word").agg(
            F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("harmless")
        ),
        "words",
    )
    suspects = counts.where("toxic >= 2 AND toxic >= 20 * harmless")
    suspects = suspects.orderBy(F.desc("toxic"), "word").limit(CANDIDATE_WORDS).select("word")
    met = words.where("label = 1").join(F.broadcast(suspects), "word")
    found: dict[str, set] = {}
    for word, doc_id in met.select("word", "doc_id").collect():
        found.setdefault(word, set()).add(doc_id)
    clean = counts.where("harmless > 0 AND harmless >= toxic")
    frequent = clean.orderBy(F.desc("harmless"), "word").limit(HARMLESS_WORDS // 2)
    spread = clean.orderBy(F.xxhash64("word"), "word").limit(HARMLESS_WORDS // 2)
    harmless = [row["word"] for row in frequent.union(spread).select("word").collect()]
    harmless = list(dict.fromkeys(harmless))
    toxic = greedy_cover(found, least=2)
    if not toxic:
        return nothing
    model = fit_words(toxic, harmless)
    rows = sample.select("label", worst_margin(model, F.col("text")).alias("m")).collect()
    dropped(sample)
    dropped(counts)
    y = np.array([row["label"] for row in rows], dtype=float)
    middle, gap = _middle(np.array([row["m"] for row in rows]), y)
    return WordModel(model.table, model.shift, middle, 4 / max(gap, 0.2))


def score_toxicity(docs: DataFrame, model: WordModel, *, name: str = "score") -> DataFrame:
    return docs.withColumn(name, model.score(worst_margin(model, F.col("text"))))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_toxicity(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
