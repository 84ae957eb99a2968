"""What the two classifiers share: the bounded training sample and a small Newton solver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def training_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, rows_per_class: int, columns: list[str], key: str = "doc_id"
) -> list[tuple]:
    """(columns..., label) of at most ``rows_per_class`` labelled keys of each class outside ``held_out``, one row a key.

    The rows with the smallest hash of their key are taken, so the choice depends on neither order nor partitions.
    Only keys and labels are sorted; the chosen keys, whose number is bounded, are broadcast to find the texts.
    Of a key's rows the smallest one is taken, so at most ``2 * rows_per_class`` rows reach the driver.
    """
    named = labels.select(F.col(key), F.col(label).alias("label")).where(~held_out & F.col("label").isin(0, 1))
    chosen = None
    for value in (0, 1):
        part = named.where(F.col("label") == value).orderBy(F.xxhash64(key), key).limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    joined = docs.join(F.broadcast(chosen.dropDuplicates([key])), key)
    found = joined.groupBy(key).agg(F.min(F.struct(*columns, "label")).alias("row")).select("row.*")
    rows = [tuple(r) for r in found.collect()]
    return sorted(rows, key=lambda r: tuple(map(str, r)))


def newton(loss, start: np.ndarray, rounds: int = 30) -> np.ndarray:
    """Minimises a convex function; ``loss`` gives (value, gradient, Hessian)."""
    x = start
    value, gradient, hessian = loss(x)
    for _ in range(rounds):
        step = np.linalg.solve(hessian + 1e-9 * np.eye(len(x)), gradient)
        rate = 1.0
        while rate > 1e-6:
            new = loss(x - rate * step)
            if new[0] <= value:
                break
            rate /= 2
        else:
            break
        x, done = x - rate * step, value - new[0] < 1e-9 * (1 + abs(value))
        value, gradient, hessian = new
        if done:
            break
    return x


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def calibration(decisions: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift that turn decisions into probabilities, with smoothed targets so that separable data stay finite."""
    positive = labels.sum()
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))

    def loss(x: np.ndarray):
        z = x[0] * decisions + x[1]
        p = sigmoid(z)
        value = np.logaddexp(0, z).sum() - (target * z).sum() + 1e-4 * x @ x
        design = np.stack([decisions, np.ones(len(z))], axis=1)
        weight = p * (1 - p)
        return value, design.T @ (p - target) + 2e-4 * x, (design * weight[:, None]).T @ design + 2e-4 * np.eye(2)

    return tuple(newton(loss, np.array([1.0, 0.0])).tolist())
