"""Quality classifier by Bradley-Terry pairwise ranking.

A document has a latent worth w.x; a preferred document beats another with
probability sigmoid(w.(x - y)).  Preference pairs come from a bounded sample of
labelled documents (label 1 over label 0); w minimises the logistic loss on
their feature differences.  Documents are accepted above a quantile of the
scores of all labelled documents: the share of low-quality labels.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import workers_import_package, written
from .labelled import labelled_rows, labelled_sample, sigmoid

MAX_ROWS = 20_000           # labelled documents the ranker is fitted on, at most
MAX_PAIRS = 100_000         # preference pairs drawn from them
BINS = 4096                 # counts a pass of the distributed quantile brings to the driver
_BLOCK = 1 << 20            # bytes of a very long text counted at a time

_CLASSES = {                # byte classes whose shares are features
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "blank": b" \t", "line": b"\n", "stop": b".,;:", "shout": b"!?", "pipe": b"|", "hash": b"#*", "money": b"$%&",
    "angle": b"<>", "bracket": b"()[]{}", "quote": b"'\"`", "join": b"-_/\\@=+~^", "beyond": bytes(range(128, 256))}
FEATURES = [*_CLASSES, "ln_words", "word_length", "distinct_words", "same_as_before", "distinct_triples",
            "distinct_lines", "line_words", "short_words", "long_words"]


def features(text: str | None) -> np.ndarray:
    """Statistics of a whole text; a null or empty text has zeros throughout."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return np.zeros(len(FEATURES))
    seen = np.zeros(256, np.int64)
    for at in range(0, len(raw), _BLOCK):
        seen += np.bincount(np.frombuffer(raw[at:at + _BLOCK], np.uint8), minlength=256)
    shares = [seen[list(members)].sum() / len(raw) for members in _CLASSES.values()]
    n = len(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    same = sum(a == b for a, b in zip(words, words[1:]))
    triples = len(set(zip(words, words[1:], words[2:]))) / (n - 2) if n > 2 else 1.0
    return np.array([*shares, np.log1p(n), min(lengths.mean(), 40.0), len(set(words)) / n, same / n, triples,
                     len(set(lines)) / len(lines), np.log1p(n / len(lines)), (lengths <= 3).mean(), (lengths > 14).mean()])


@dataclass(frozen=True)
class Ranker:
    """score = sigmoid(slope * (worth - threshold)); the threshold is the score quantile."""
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float
    slope: float

    def worth(self, x: np.ndarray) -> np.ndarray:
        # row by row: equal rows have equal sums, whatever stands around them
        return (np.clip((x - self.mean) / self.scale, -8, 8) * self.weights).sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * (self.worth(x) - self.threshold))


def bradley_terry(winners: np.ndarray, losers: np.ndarray, ridge: float = 1e-2, steps: int = 25) -> np.ndarray:
    """Weights that minimise the mean logistic loss on winner - loser, by Newton steps."""
    diff = winners - losers
    w = np.zeros(diff.shape[1])
    for _ in range(steps):
        p = sigmoid(diff @ w)
        gradient = diff.T @ (p - 1) / len(diff) + ridge * w
        hessian = (diff * (p * (1 - p))[:, None]).T @ diff / len(diff) + ridge * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def quantile_threshold(worth: np.ndarray, weight: np.ndarray, share: float) -> float:
    """The weighted `share` quantile, midway between the neighbouring values."""
    order = np.argsort(worth, kind="stable")
    below = np.cumsum(weight[order]) / weight.sum()
    at = int(np.searchsorted(below, share - 1e-9)) + 1
    at = min(max(at, 1), len(worth) - 1)
    return float((worth[order[at - 1]] + worth[order[at]]) / 2)


def distributed_threshold(worths: DataFrame, share: float) -> float:
    """`quantile_threshold` of the column `worth`, each row once, exactly: counts of BINS
    equal bins a pass, then of the bin that holds the wanted rank, until it is one value."""
    low, high, n = worths.agg(F.min("worth"), F.max("worth"), F.count("worth")).first()
    rank, before = min(max(math.ceil((share - 1e-9) * n), 1), max(n - 1, 1)), 0
    worth = F.col("worth")
    while low < high:
        at = F.least(F.floor((worth - low) / (high - low) * BINS), F.lit(BINS - 1))
        for b in worths.where((worth >= low) & (worth <= high)).groupBy(at.alias("bin")).agg(
                F.count("*").alias("n"), F.min(worth).alias("low"), F.max(worth).alias("high")).orderBy("bin").collect():
            if before + b["n"] >= rank:
                low, high = b["low"], b["high"]
                break
            before += b["n"]
    upto, after = worths.agg(F.count(F.when(worth <= low, 1)), F.min(F.when(worth > low, worth))).first()
    return float((low + (low if upto > rank or after is None else after)) / 2)


def fit(x: np.ndarray, label: np.ndarray, counts: dict[int, int], max_pairs: int = MAX_PAIRS) -> Ranker:
    """Fit on sampled rows; `counts` are the label counts over all labelled rows, from
    which the quantile and the rows' weights follow.  The threshold is the sample's:
    `train` sets it over all labelled documents.  Without both labels
    every document scores the same: 1 if only label 1 was seen, else 0."""
    zeros = np.zeros(x.shape[1])
    if not (label == 0).any() or not (label == 1).any():
        return Ranker(zeros, zeros + 1, zeros, -1.0 if (label == 1).any() else 1.0, 60.0)
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    rng = np.random.default_rng(11)
    n = min(max_pairs, max(len(good), len(bad)) * 20)
    w = bradley_terry(z[rng.choice(good, n)], z[rng.choice(bad, n)])
    worth = z @ w
    weight = np.where(label == 1, counts[1] / len(good), counts[0] / len(bad))
    threshold = quantile_threshold(worth, weight, counts[0] / (counts[0] + counts[1]))
    slope = 4.0 / max(worth[good].mean() - worth[bad].mean(), 1e-9)
    return Ranker(mean, scale, w, threshold, slope)


def train(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality", max_rows: int = MAX_ROWS,
          id_col: str = "doc_id", text_col: str = "text") -> Ranker:
    workers_import_package(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def featurise(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])
    rows, counts = labelled_sample(docs, labels, label_col, learn, max_rows, id_col, text_col)
    got = rows.select("doc_id", "label", featurise("text").alias("x")).orderBy("doc_id").toPandas()
    x = np.array(got["x"].tolist(), float).reshape(-1, len(FEATURES))
    ranker = fit(x, got["label"].to_numpy(int), counts)
    if not ranker.weights.any():        # a label is missing: the threshold is a constant
        return ranker

    @F.pandas_udf("double")
    def worth(texts: pd.Series) -> pd.Series:
        return pd.Series(ranker.worth(np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))))
    # sampling is for the fit alone: the threshold is taken over all labelled documents
    worths = written(labelled_rows(docs, labels, label_col, learn, id_col, text_col).select(
        worth("text").alias("worth")), "ranker-worths")
    return replace(ranker, threshold=distributed_threshold(worths, counts[0] / (counts[0] + counts[1])))


def score_column(ranker: Ranker, text: Column) -> Column:
    """Score of a text, 0 to 1 (null and empty texts too)."""
    @F.pandas_udf("double")
    def udf(texts: pd.Series) -> pd.Series:
        x = np.array([features(t) for t in texts], float).reshape(-1, len(FEATURES))
        return pd.Series(ranker.score(x))
    return udf(text)


def rank(docs: DataFrame, labels: DataFrame, learn: Column, label_col: str = "quality",
         max_rows: int = MAX_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of `docs`: doc_id, score, predicted (1 if score >= 0.5, else 0).

    Null and empty texts have the score of a text without words.  Null and
    repeated ids keep their rows.  Other columns are not read.  An empty
    table gives an empty table; without labels see `fit`."""
    ranker = train(docs, labels, learn, label_col, max_rows, id_col, text_col)
    scored = docs.select(F.col(f"`{id_col}`").alias("doc_id"),
                         score_column(ranker, F.col(f"`{text_col}`")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
