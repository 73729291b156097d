"""Bounded labelled samples and a small logistic fit for calibrated scores."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fundlens.llm.common import held_out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, salt: str,
                    id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, y) of at most ``per_class`` training rows a class, and the class sizes.

    The sample takes the least salted hashes of the ids that are not held out; an id labelled
    twice takes its greatest label.  The sampled ids are broadcast: they are bounded by
    ``per_class``.  A text that repeats an id counts once (the least text).
    """
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
             .where("doc_id IS NOT NULL AND y IN (0, 1)").where(~held_out("doc_id"))
             .groupBy("doc_id").agg(F.max("y").alias("y")))
    sizes = {0: 0, 1: 0} | {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    order = F.md5(F.concat(F.lit(salt), F.col("doc_id").cast("string")))
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    texts = (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
             .join(F.broadcast(ids), "doc_id").groupBy("doc_id", "y").agg(F.min("text").alias("text")))
    return texts.where("text IS NOT NULL"), sizes


def class_weights(y: np.ndarray, sizes: dict[int, int]) -> np.ndarray:
    """Weights that give the sample's classes their shares of all labelled rows."""
    have = [max(1, int((y == c).sum())) for c in (0, 1)]
    return np.array([sizes[c] / have[c] for c in (0, 1)])[y]


def calibrate(x: np.ndarray, y: np.ndarray, sizes: dict[int, int], prior: float, ridge: float = 1.0) -> np.ndarray:
    """Coefficients for a sample weighted to the classes' shares of all labelled rows.

    A sample without rows of both classes gives the share of class 1 among all labelled
    rows, smoothed by one row of which ``prior`` is class 1.
    """
    if len(set(y.tolist())) < 2:
        share = (sizes[1] + prior) / (sizes[0] + sizes[1] + 1)
        return np.array([np.log(share / (1 - share)), *np.zeros(x.shape[1])])
    return logistic(x, y, class_weights(y, sizes), ridge)


def logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Coefficients (intercept first) of a weighted ridge logistic regression by Newton steps."""
    beta = np.zeros(x.shape[1] + 1)
    ones, total = float((w * y).sum()), float(w.sum())
    beta[0] = np.log((ones + 0.5) / (total - ones + 0.5))
    w = w * len(y) / total
    a = np.column_stack([np.ones(len(x)), x])
    penalty = np.full(a.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        grad = a.T @ (w * (y - p)) - penalty * beta
        step = np.linalg.solve((a * (w * p * (1 - p))[:, None]).T @ a + np.diag(penalty), grad)
        beta += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def probability(x: np.ndarray, beta: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(beta[0] + x @ beta[1:], -30, 30)))
