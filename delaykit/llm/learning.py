"""What the learned operators share: labelled samples and small logistic fits."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delaykit.llm.shared import held_out


def known_labels(labels: DataFrame, label_col: str, id_col: str = "doc_id") -> DataFrame:
    """``_id`` and ``_label`` of the rows to learn from.

    Held-out rows, null ids and null labels are left out; of an id with several labels the
    largest counts.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    return known.groupBy(F.col(id_col).alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_label"))


def labelled_sample(
    labels: DataFrame, label_col: str, max_rows: int, id_col: str = "doc_id"
) -> tuple[DataFrame, dict[int, int]]:
    """At most ``max_rows`` labelled ids of each class to learn from, and the class sizes.

    Of ``known_labels`` those with the smallest hashes of their ids. Their number is bounded
    whatever the size of ``labels``.
    """
    known = known_labels(labels, label_col, id_col)
    sizes = {r["_label"]: r["n"] for r in known.groupBy("_label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [
        known.where(F.col("_label") == c).orderBy(F.xxhash64("_id"), "_id").limit(max_rows) for c in (0, 1)
    ]
    return picked[0].union(picked[1]), sizes


def one_per_id(rows: DataFrame, col: str) -> DataFrame:
    """Of rows ``_id``, ``_label`` and ``col`` one for each id, so that the sample's bound holds for rows."""
    return rows.groupBy("_id", "_label").agg(F.min_by(col, F.xxhash64(col)).alias(col))


def newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float, steps: int = 12) -> np.ndarray:
    """Logistic regression without intercept: minimises the weighted loss plus a ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + ridge * w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max(initial=0.0) < 1e-6:
            break
    return w
