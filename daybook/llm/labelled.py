"""A bounded sample of labelled texts, the only data that classifiers of this subpackage learn from."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5
#: Most rows of either label, and most bytes of a text, that a sample holds.
MOST_ROWS, MOST_BYTES = 2000, 1 << 16


def held_out(doc_id: Column) -> Column:
    """True where crc32 of doc_id as text leaves no remainder; false for a null doc_id."""
    remainder = F.crc32(F.encode(doc_id.cast("string"), "utf-8")) % FOLDS
    return F.coalesce(remainder == 0, F.lit(False))


@dataclass(frozen=True)
class Labelled:
    raw: bytes
    label: int
    calibrates: bool


def sample(
    docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES
) -> list[Labelled]:
    """Up to ``most_rows`` texts of each quality label, by the order of a hash of doc_id.

    Rows that are held out, without doc_id, text or label, or longer than ``most_bytes`` are left out,
    and a label given twice counts once. A third of the rows is marked for calibration. The sample is
    ordered, so reruns learn the same.
    """
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
        .distinct()
        .withColumn("at", F.xxhash64("doc_id"))
    )
    picked = known.filter("label = 0").orderBy("at", "doc_id").limit(most_rows).unionByName(
        known.filter("label = 1").orderBy("at", "doc_id").limit(most_rows)
    )
    rows = (
        docs.select("doc_id", "text")
        .filter(F.octet_length("text") <= most_bytes)
        .join(F.broadcast(picked), "doc_id")  # at most twice most_rows rows of three numbers
        .select("at", "doc_id", "label", "text")
        .distinct()
        .orderBy("at", "doc_id", "label", "text")
        .limit(2 * most_rows)
        .collect()
    )
    return [Labelled(r["text"].encode("utf-8", "replace"), r["label"], r["at"] % 3 == 0) for r in rows]


def share_of_good(labels: DataFrame) -> float:
    """The share of label 1 among all rows that may be learned from, kept off 0 and 1."""
    good, all_rows = (
        labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
        .agg(F.sum("quality"), F.count("*"))
        .first()
    )
    return (float(good or 0) + 1) / (all_rows + 2)


def calibrated(values: np.ndarray, labels: np.ndarray, share: float, ridge: float = 1e-6) -> tuple[float, float]:
    """(slope, intercept) of a logistic curve through ``values``, rows weighted to ``share`` of label 1.

    With one label only, or no rows, the curve is flat at ``share``.
    """
    prior = math.log(share / (1 - share))
    good, bad = int((labels == 1).sum()), int((labels == 0).sum())
    if not good or not bad:
        return 0.0, prior
    scale = float(values.std()) or 1.0
    x = np.column_stack([values / scale, np.ones(len(values))])
    weight = np.where(labels == 1, share / good, (1 - share) / bad)
    beta = np.array([0.0, prior])
    for _ in range(100):  # Newton steps on a strictly convex loss of two unknowns
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (weight * (p - labels)) + ridge * np.array([beta[0], 0.0])
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ x + ridge * np.diag([1.0, 1e-3])
        step = np.linalg.solve(curve, gradient)
        beta -= step * min(1.0, 2.0 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-9:
            break
    return float(beta[0] / scale), float(beta[1])
