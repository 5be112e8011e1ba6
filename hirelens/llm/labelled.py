"""Bounded samples of labelled rows, and the calibration the classifiers share."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelens.llm.common import with_columns_last

#: The fit's bounds: rows of each class at most, and characters of a row at most.
MAX_ROWS = 2500
MAX_CHARS = 20_000


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the doc_id as text, modulo ``n`` (null: null)."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def labelled_texts(docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int = MAX_ROWS,
                   max_chars: int = MAX_CHARS) -> tuple[DataFrame, float]:
    """Texts and labels to learn from (``doc_id``, ``text``, ``y``), and the share of label 1 among all rows one may learn from.

    Of each class the ``max_rows`` rows that a hash of doc_id puts first, texts
    over ``max_chars`` left out: the one part of the classifiers that is sampled.
    A doc_id labelled twice counts once, by its larger label; null labels don't count.
    """
    known = labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & learn).groupBy("doc_id").agg(F.max(label).alias("y"))
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = counts.get(1, 0) / max(1, sum(counts.values()))
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for y in (0, 1)]
    picked = F.broadcast(parts[0].unionByName(parts[1]))  # 2 * max_rows rows of two numbers at most
    texts = docs.join(picked, "doc_id").where(F.char_length("text") <= max_chars).groupBy("doc_id").agg(
        F.max("y").alias("y"), F.min("text").alias("text"))
    return texts.select("doc_id", "text", "y"), share


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column) -> tuple[pd.DataFrame, float]:
    """:func:`labelled_texts` in the driver, by doc_id."""
    texts, share = labelled_texts(docs, labels, label, learn)
    return texts.toPandas().sort_values("doc_id", ignore_index=True), share


def logistic(x: np.ndarray, y: np.ndarray, share: float, steps: int = 50, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept that turn a score into the probability of label 1, classes weighted to ``share``."""
    if len(set(y.tolist())) < 2:
        p = min(max(share, 1e-3), 1 - 1e-3)
        return 0.0, float(np.log(p / (1 - p)))
    scale = float(x.std()) or 1.0
    u = np.stack([x / scale, np.ones(len(x))], axis=1)
    weight = np.where(y == 1, share / y.mean(), (1 - share) / (1 - y.mean()))
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(u @ w, -30, 30)))
        grad = u.T @ (weight * (p - y)) + ridge * w
        hess = (u * (weight * p * (1 - p))[:, None]).T @ u + ridge * np.eye(2)
        step = np.linalg.solve(hess, grad)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0] / scale), float(w[1])


def probability(x: np.ndarray, slope: float, intercept: float) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(slope * x + intercept, -40, 40)))


def with_scores(docs: DataFrame, held: Column, score: Column) -> DataFrame:
    """``docs`` with held_out (a null doc_id is never held out), score and predicted; input columns of these names go."""
    kept = with_columns_last(docs, ["held_out", "score", "predicted"])
    scored = kept.withColumn("held_out", F.coalesce(held, F.lit(False))).withColumn("score", score)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
