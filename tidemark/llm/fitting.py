"""Small models fitted on the driver to a bounded sample of labelled rows."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Whether a row is kept from fitting: crc32 of its id as text is divisible by ``folds``.

    A null id is held out."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % folds
    return F.coalesce(rest == 0, F.lit(True))


def labelled_sample(labels: DataFrame, label_col: str, rows: int, id_col: str = "doc_id") -> DataFrame:
    """At most ``rows`` ids of each label, ``(doc_id, label)``, none of them held out.

    Those with the smallest hash of the id, so the choice is the same at each run. Labels other than
    0 and 1 and ids with both labels are ignored, repeats count once.
    """
    known = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & ~held_out("doc_id"))
    known = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("top"))
    known = known.where("label = top").drop("top")
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    parts = [known.where(F.col("label") == x).orderBy(*order).limit(rows) for x in (0, 1)]
    return parts[0].union(parts[1])


def fit_logistic(
    x: np.ndarray, y: np.ndarray | None = None, ridge: float = 1.0, rounds: int = 25
) -> np.ndarray:
    """Weights that minimise logistic loss plus ridge, by Newton's method.

    ``y`` holds 0 and 1; without it every row of ``x`` is a difference that should be positive.
    """
    target = np.ones(len(x)) if y is None else y.astype(float)
    weights = np.zeros(x.shape[1])
    for _ in range(rounds if len(x) else 0):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -35, 35)))
        slope = x.T @ (p - target) + ridge * weights
        curve = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 5.0 / (np.abs(x @ step).max() + 1e-9))
        if np.abs(step).max() < 1e-6:
            break
    return weights
