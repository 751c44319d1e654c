"""Toxicity classifier with a counterfactual penalty.

Logistic regression on the words of a document and their beginnings: which
stand in it, and which are dense in it.  Every sentence of a labelled document
that mentions a group is written again with another group's term; both are
scored, and the squared change of the score is added to the loss, so that a
mention as such moves no score.  Weights are sparse and not negative: a
document is toxic by what it says, and long clean text around it takes nothing
away.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import workers_import_package, written
from .labelled import labelled_sample, sigmoid

MAX_ROWS = 20_000           # labelled documents the classifier is fitted on, at most
MAX_FEATURES = 2_000        # words and beginnings of words with a weight, at most
PREFIXES = (3, 4, 5, 6, 7, 8)
DENSITIES = ((0.002, "#2"), (0.008, "#8"))     # shares of a document's words, and their marks
_WORD = re.compile(r"[^\W\d_]+")
_SENTENCE = re.compile(r"[^.!?\n]+")
_COUNTED = 500_000          # features a task counts before it passes the counts on
_REMEMBERED = 400_000       # words a worker remembers before it starts afresh

MAX_SWAPS = 10_000          # kinds of score changes the penalty is over, at most (the commonest)

# Group terms by kind, where no others are given; a swap stays within its kind.
IDENTITY_TERMS = {
    "faith": ["christian", "muslim", "jewish", "hindu", "buddhist", "sikh", "catholic", "atheist"],
    "origin": ["african", "american", "asian", "european", "mexican", "arab", "indian", "chinese", "german", "french"],
    "gender": ["man", "woman", "male", "female", "transgender", "nonbinary"],
    "orientation": ["gay", "lesbian", "straight", "bisexual", "queer", "heterosexual"],
    "colour": ["black", "white", "brown"],
    "ability": ["blind", "deaf", "disabled", "autistic", "sighted", "hearing"],
    "age": ["young", "old", "elderly", "teenage"],
}


def swaps_of(terms: dict[str, list[str]]) -> dict[str, str]:
    """Each term (one word) -> the next one of its kind."""
    return {a: b for kind in terms.values() for a, b in zip(kind, kind[1:] + kind[:1])}


SWAP = swaps_of(IDENTITY_TERMS)


def word_features(word: str) -> list[str]:
    """The word itself (marked by $) and its beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) >= k)]


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def marked(counts: dict[str, int], n_words: int) -> list[str]:
    """Features of a document: every stem that stands in it, and again with a mark for
    each density it reaches."""
    out = list(counts)
    for share, mark in DENSITIES:
        out += [f + mark for f, c in counts.items() if c >= share * n_words]
    return out


def document_features(text: str | None, stems: set[str] | None = None) -> list[str]:
    """Features of a text, of the given stems only (default: of all)."""
    words = words_of(text)
    counts: dict[str, int] = {}
    for word, c in Counter(words).items():
        for f in word_features(word):
            if stems is None or f in stems:
                counts[f] = counts.get(f, 0) + c
    return marked(counts, len(words))


def counterfactuals(text: str | None, swap: dict[str, str]) -> Iterator[tuple[str, str]]:
    """(sentence, the same with every group's term swapped) of the sentences that have one."""
    for sentence in _SENTENCE.findall((text or "").lower()):
        other = _WORD.sub(lambda m: swap.get(m[0], m[0]), sentence)
        if other != sentence:
            yield sentence, other


def score_change(sentence: str, other: str, stems: set[str], number: dict[str, int]) -> tuple[list[int], list[int]]:
    """Numbers of the features that a sentence loses and gains when it becomes the other."""
    was, now = ({number[f] for f in document_features(t, stems) if f in number} for t in (sentence, other))
    return sorted(was - now), sorted(now - was)


@dataclass(frozen=True)
class Classifier:
    weights: dict[str, float]       # of the features that have one
    intercept: float

    def scorer(self):
        """Function of a text; remembers which stems a word has."""
        known, weights = {}, self.weights
        stems = {f.partition("#")[0] for f in weights}

        def score(text: str | None) -> float:
            if len(known) > _REMEMBERED:
                known.clear()
            words, counts = words_of(text), {}
            for word, c in Counter(words).items():
                hits = known.get(word)
                if hits is None:
                    hits = known[word] = tuple(f for f in word_features(word) if f in stems)
                for f in hits:
                    counts[f] = counts.get(f, 0) + c
            return self.intercept + sum(weights.get(f, 0.0) for f in sorted(marked(counts, len(words))))
        return score


def fit(rows: list[np.ndarray], label: np.ndarray, swaps: list[tuple[list[int], list[int]]], swap_weight: np.ndarray,
        n_features: int, penalty: float, sparse: float = 1e-4, tolerance: float = 1e-6,
        steps: int = 100_000) -> tuple[np.ndarray, float]:
    """Balanced logistic loss + `sparse` * sum(w) + `penalty` * mean over swaps of the squared
    score change, w >= 0, by accelerated projected gradient steps until none moves a
    weight by `tolerance` (`steps` only ends a fit that never would).

    rows: feature numbers of each document; swaps: feature numbers (lost, gained)
    of each kind of swapped sentence, with their frequency."""
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    feat = np.concatenate(rows) if len(rows) else np.zeros(0, int)
    weight = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    kind = np.repeat(np.arange(len(swaps)), [len(a) + len(b) for a, b in swaps])
    part = np.array([f for a, b in swaps for f in (*a, *b)], int)
    sign = np.array([x for a, b in swaps for x in (*[1.0] * len(a), *[-1.0] * len(b))])
    share = swap_weight / max(swap_weight.sum(), 1e-12)

    def unfair(v: np.ndarray) -> np.ndarray:
        """Gradient of the mean squared score change."""
        if not len(swaps):
            return np.zeros(n_features)
        change = share * np.bincount(kind, sign * v[part], len(swaps))
        return 2 * np.bincount(part, sign * change[kind], n_features)
    # step size from a bound of the curvature: power iteration on the weighted data
    v = np.ones(n_features + 1)
    bound = 1.0
    for _ in range(30):
        at = weight * (np.bincount(doc, v[feat], len(rows)) + v[-1])
        u = np.append(0.25 * np.bincount(feat, at[doc], n_features), 0.25 * at.sum())
        u[:-1] += penalty * unfair(v[:-1])
        bound = max(np.linalg.norm(u) / max(np.linalg.norm(v), 1e-12), 1e-9)
        v = u / max(np.linalg.norm(u), 1e-12)
    w, b = np.zeros(n_features), 0.0
    yw, yb, t = w, b, 1.0
    for _ in range(steps):
        p = sigmoid(np.bincount(doc, yw[feat], len(rows)) + yb)
        error = weight * (p - label)
        gradient = np.bincount(feat, error[doc], n_features) + penalty * unfair(yw)
        nw = np.maximum(0.0, yw - (gradient + sparse) / (1.2 * bound))
        nb = yb - error.sum() / (1.2 * bound)
        moved = max(np.abs(nw - w).max(initial=0.0), abs(nb - b), np.abs(nw - yw).max(initial=0.0))
        if moved < tolerance:
            w, b = nw, nb
            break
        if (yw - nw) @ (nw - w) + (yb - nb) * (nb - b) > 0:     # past the lowest point: start the momentum anew
            t = 1.0
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        yw, yb = nw + (t - 1) / nt * (nw - w), nb + (t - 1) / nt * (nb - b)
        w, b, t = nw, nb, nt
    return w, b


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", max_rows: int = MAX_ROWS,
          penalty: float = 10.0, max_features: int = MAX_FEATURES, id_col: str = "doc_id",
          text_col: str = "text", terms: dict[str, list[str]] | None = None) -> Classifier:
    """Fit on a bounded sample.  Features are the `max_features` words and beginnings most
    tied to label 1, and those of all identity terms (`terms`: kind -> words).
    Without both labels no feature has a weight and all scores are 0.5, or lean to
    the label seen."""
    workers_import_package(docs.sparkSession)
    swap = swaps_of(IDENTITY_TERMS if terms is None else terms)
    rows, _ = labelled_sample(docs, labels, label_col, learn, max_rows, id_col, text_col)
    rows = written(rows, "toxicity-sample")
    sampled = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not sampled.get(0) or not sampled.get(1):
        return Classifier({}, 4.0 if sampled.get(1) else -4.0 if sampled.get(0) else 0.0)
    # stems first, then the densities of the stems that may matter
    stems = set(_most_tied(rows, lambda t: {f for w in set(words_of(t)) for f in word_features(w)}, sampled, 0.5,
                           4 * max_features))
    names = _most_tied(rows, lambda t: document_features(t, stems), sampled, 1.0, max_features)
    marks = ["", *(mark for _, mark in DENSITIES)]      # a swap changes the term's stems at any density
    names += sorted({f + m for t in swap for f in word_features(t) for m in marks} - set(names))
    number = {f: i for i, f in enumerate(names)}
    known = {f.partition("#")[0] for f in names}

    def select(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({
                "doc_id": batch["doc_id"], "label": batch["label"],
                "at": [sorted(number[f] for f in document_features(t, known) if f in number) for t in batch["text"]]})

    def changes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = Counter()
            for text in batch.column("text").to_pylist():
                for pair in counterfactuals(text, swap):
                    lost, gained = score_change(*pair, known, number)
                    seen[tuple(lost), tuple(gained)] += 1
            yield pa.RecordBatch.from_pydict({
                "lost": pa.array([list(a) for a, _ in seen], pa.list_(pa.int32())),
                "gained": pa.array([list(b) for _, b in seen], pa.list_(pa.int32())),
                "n": pa.array(list(seen.values()), pa.int64())})
    got = rows.mapInPandas(select, "doc_id long, label int, at array<int>").orderBy("doc_id").toPandas()
    kinds = rows.mapInArrow(changes, "lost array<int>, gained array<int>, n long").groupBy("lost", "gained").agg(
        F.sum("n").alias("n")).orderBy(F.col("n").desc(), "lost", "gained").limit(MAX_SWAPS).collect()
    w, b = fit([np.asarray(r, int) for r in got["at"]], got["label"].to_numpy(float),
               [(r["lost"], r["gained"]) for r in kinds], np.array([r["n"] for r in kinds], float), len(names), penalty)
    return Classifier({f: float(w[i]) for f, i in number.items() if w[i] > 0}, float(b))


def _most_tied(rows: DataFrame, features: Callable[[str | None], Iterable[str]], sampled: dict[int, int],
               least_odds: float, most: int) -> list[str]:
    """The `most` features of `rows(label, text)` with the strongest tie to label 1: log odds
    times the root of their number of documents with label 1, of two at least."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                seen[y].update(features(text))
                if len(seen[0]) + len(seen[1]) > _COUNTED:
                    yield from _counts(seen)
                    seen = (Counter(), Counter())
        yield from _counts(seen)
    odds = F.log((F.col("p") + 0.5) / (sampled[1] + 1)) - F.log((F.col("n") + 0.5) / (sampled[0] + 1))
    found = rows.mapInArrow(count, "feature string, p long, n long").groupBy("feature").agg(
        F.sum("p").alias("p"), F.sum("n").alias("n")).where("p >= 2").where(odds > least_odds)
    return [r["feature"] for r in found.orderBy((odds * F.sqrt("p")).desc(), "feature").limit(most).collect()]


def _counts(seen: tuple[Counter, Counter], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    names = sorted(seen[0].keys() | seen[1].keys())
    for a in range(0, len(names), rows):
        part = names[a:a + rows]
        yield pa.RecordBatch.from_pydict({
            "feature": pa.array(part, pa.string()), "p": pa.array([seen[1][f] for f in part], pa.int64()),
            "n": pa.array([seen[0][f] for f in part], pa.int64())})


def score_column(model: Classifier, text: Column) -> Column:
    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        score = model.scorer()
        for texts in batches:
            yield pd.Series(sigmoid(np.array([score(t) for t in texts], float)))
    return udf(text)


def classify(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "toxic", max_rows: int = MAX_ROWS,
             penalty: float = 10.0, id_col: str = "doc_id", text_col: str = "text",
             terms: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per row of `docs`: doc_id, score (0 to 1), predicted (1 if score >= 0.5, else 0).

    Null and empty texts have the intercept's score.  Null and repeated ids keep
    their rows.  Other columns are not read.  An empty table gives an empty
    table; without labels see `train`."""
    model = train(docs, labels, learn, label_col, max_rows, penalty, id_col=id_col, text_col=text_col, terms=terms)
    scored = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                         score_column(model, F.col(f"`{text_col}`")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
