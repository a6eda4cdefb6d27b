"""Quality scores learned from preference pairs (Bradley-Terry)."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.columns import pick, text_or_empty
from tidemark.llm.fitting import fit_logistic, held_out, labelled_sample

#: Labelled documents of either label that the model is fitted to, at most, and pairs of them.
SAMPLE, PAIRS = 8000, 40_000

#: Classes of bytes: other, lower, upper, digit, blank, line end, beyond ASCII, then marks.
_MARKS = b".,;:!?|*#%&$@-_'\"()<>/=+"
_CLASSES = 7 + len(_MARKS)
_CLASS = np.zeros(256, np.int64)
for _b in range(256):
    _c = bytes([_b])
    if _b >= 128:
        _CLASS[_b] = 6
    elif _c in _MARKS:
        _CLASS[_b] = 7 + _MARKS.index(_c)
    else:
        _tests = (_c.islower(), _c.isupper(), _c.isdigit(), _c in b" \t", _c in b"\r\n")
        _CLASS[_b] = _tests.index(True) + 1 if any(_tests) else 0
N_FEATURES = 13 + _CLASSES + 7 * 7


def features(text: str) -> np.ndarray:
    """Numbers that describe how a text is written, whatever its language and length.

    Shares of kinds of characters and of kinds that follow each other, sizes of words and lines,
    and how much is repeated. An empty text has all zeros.
    """
    out = np.zeros(N_FEATURES, np.float32)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    if not words:
        return out
    kinds = _CLASS[np.frombuffer(data, np.uint8)]
    n, w = len(kinds), len(words)
    counts = Counter(words)
    lines = data.split(b"\n")
    lengths = np.array([len(x) for x in words])
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    top = [k for _, k in counts.most_common(3)]
    out[:13] = (
        np.log1p(w) / 5,
        np.log1p(len(lines)) / 3,
        np.log1p(n / len(lines)) / 5,
        len(counts) / w,
        len(counts) / w**0.8,
        top[0] / w,
        sum(top) / w,
        repeats / w,
        len(set(lines)) / len(lines),
        lengths.mean() / 10,
        lengths.std() / 10,
        (lengths <= 3).mean(),
        sum(1 for x in words if x[-1:] in b".!?") / w,
    )
    out[13 : 13 + _CLASSES] = np.sqrt(np.bincount(kinds, minlength=_CLASSES) / n)
    broad = np.minimum(kinds, 6)
    if n > 1:
        pairs = np.bincount(broad[:-1] * 7 + broad[1:], minlength=49)
        out[13 + _CLASSES :] = np.sqrt(pairs / (n - 1))
    return out


def _matrix(texts) -> np.ndarray:
    return np.array([features(t) for t in texts], np.float64).reshape(-1, N_FEATURES)


class PairwiseModel:
    """Linear scores by which the better of two documents tends to have the higher one.

    ``weights`` minimise the logistic loss of the feature differences of preference pairs. The
    score's log odds of a document being good are a linear function fitted to single labels.
    """

    def __init__(self, x: np.ndarray, y: np.ndarray, share: float, pairs: int, seed: int = 0):
        self.mean = x.mean(axis=0) if len(x) else np.zeros(N_FEATURES)
        self.scale = (x.std(axis=0) if len(x) else np.zeros(N_FEATURES)) + 1e-6
        z = self._standard(x)
        good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
        self.weights, self.slope, self.offset = np.zeros(N_FEATURES), 0.0, 0.0
        if len(good) and len(bad):
            chance = np.random.default_rng(seed)
            left, right = chance.choice(good, pairs), chance.choice(bad, pairs)
            self.weights = fit_logistic(z[left] - z[right], ridge=10.0)
            scores = z @ self.weights
            fit = fit_logistic(np.column_stack([scores, np.ones(len(z))]), y, ridge=0.01)
            # the sample has its own share of good ones
            shift = np.log(share / (1 - share)) - np.log(len(good) / len(bad))
            self.slope, self.offset = float(fit[0]), float(fit[1] + shift)
        elif len(good) + len(bad):
            self.offset = 5.0 if len(good) else -5.0

    def _standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self._standard(x) @ self.weights

    def probability(self, strength: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * strength + self.offset, -35, 35)))


def fit(
    documents: DataFrame,
    labels: DataFrame,
    sample: int = SAMPLE,
    pairs: int = PAIRS,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> PairwiseModel:
    """A model of the labels, fitted to at most ``sample`` documents of each and ``pairs`` pairs.

    Rows whose id is held out are not used. The sampled ids are broadcast, so that only their
    documents are turned into features and nothing is shuffled; only features reach the driver.
    Without labels, or with one label only, all documents get the same score.
    """
    chosen = labelled_sample(labels, label_col, sample, id_col)
    as_features = F.pandas_udf(lambda s: pd.Series(list(_matrix(s).astype(np.float32))), "array<float>")
    docs = pick(documents, doc_id=id_col, text=text_col).join(F.broadcast(chosen), "doc_id")
    rows = docs.select("label", as_features(text_or_empty("text")).alias("x")).toPandas()
    known = labels.where(F.col(label_col).isin(0, 1) & ~held_out(id_col))
    share = known.agg((F.sum(label_col) + 1) / (F.count("*") + 2)).first()[0] or 0.5
    x = np.array(rows["x"].tolist(), np.float64).reshape(-1, N_FEATURES)
    y = rows["label"].to_numpy(np.int64)
    order = np.lexsort((*x.T[:8], y))  # rows arrive in any order
    return PairwiseModel(x[order], y[order], float(share), pairs)


def score(documents: DataFrame, model: PairwiseModel, text_col: str = "text") -> DataFrame:
    """The documents with ``strength`` (the pairwise model's own scale) and ``score``, the
    probability of label 1. Null and empty texts are scored as texts without any features."""

    def run(texts: pd.Series) -> pd.DataFrame:
        strength = model.strength(_matrix(texts))
        return pd.DataFrame({"strength": strength, "score": model.probability(strength)})

    scored = F.pandas_udf(run, "strength double, score double").asNondeterministic()
    rows = documents.withColumn("__scored", scored(text_or_empty(text_col)))
    return rows.withColumns(
        {"strength": F.col("__scored.strength"), "score": F.col("__scored.score")}
    ).drop("__scored")


def best(scored: DataFrame, share: float, score_col: str = "strength") -> DataFrame:
    """The documents at or above the score that a ``share`` of all documents reaches.

    The quantile is Spark's approximate one, at a relative error of 1 in 10,000. Ties stay."""
    least = scored.agg(F.percentile_approx(score_col, 1 - share, 10_000)).first()[0]
    return scored.where(F.col(score_col) >= F.lit(least))


def predicted(score: Column, least: float) -> Column:
    return (score >= least).cast("int")
