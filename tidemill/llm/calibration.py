"""Isotonic calibration from binned counts: the bins are a fixed number, so they may meet on the driver."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BINS = 4096


def binned(rows: DataFrame, x: Column, y: Column, low: float, high: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(mean x, sum of y, rows) of each of the BINS equal parts of [low, high] that has rows; x beyond counts at the ends."""
    part = F.least(F.greatest(F.floor((x - low) / (high - low) * BINS), F.lit(0)), F.lit(BINS - 1))
    found = rows.select(part.alias("part"), x.alias("x"), y.alias("y")).groupBy("part").agg(
        F.avg("x").alias("x"), F.sum("y").alias("y"), F.count("*").alias("n")).orderBy("part").toPandas()
    return found["x"].to_numpy(float), found["y"].to_numpy(float), found["n"].to_numpy(float)


class Isotonic:
    """The rising curve nearest to the bins' means, joined linearly; falls back to ``empty`` without rows."""

    def __init__(self, x: np.ndarray, y: np.ndarray, n: np.ndarray, empty: float = 0.5):
        blocks: list[list[float]] = []  # sum of y, rows, sum of x
        for xi, yi, ni in zip(x, y, n):
            blocks.append([yi, ni, xi * ni])
            while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
                last = blocks.pop()
                blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
        self.x = np.array([b[2] / b[1] for b in blocks] or [0.0])
        self.y = np.array([b[0] / b[1] for b in blocks] or [empty])
        self.low, self.high = (float(x[0]), float(x[-1])) if len(x) else (0.0, 1.0)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        """Scores in [0, 1]; a thousandth of the score keeps the order within flat parts."""
        flat = (np.clip(x, self.low, self.high) - self.low) / max(self.high - self.low, 1e-12)
        return np.clip(0.999 * np.interp(x, self.x, self.y) + 0.001 * flat, 0.0, 1.0)
