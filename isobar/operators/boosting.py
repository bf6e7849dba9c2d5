"""Gradient-boosted stumps for a mean, with row weights.

Features are binned at quantiles. Rows with the same bins are one cell: sums of
weights and of weighted labels are all that squared loss needs, so one
aggregate brings at most (bins + 2) ** features cells to the driver, whatever
the number of rows, and all rounds run on these. The model is a list of stumps
and its prediction a column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells that may come to the driver.
MOST_CELLS = 2_000_000


@dataclass
class Model:
    base: float
    #: feature, threshold, value at or below it, value above it or without the feature
    stumps: list[tuple[str, float, float, float]]

    def predict(self) -> Column:
        out = F.lit(self.base)
        for feature, threshold, left, right in self.stumps:
            out = out + F.when(F.col(feature) <= threshold, left).otherwise(right)
        return out


def bin_edges(df: DataFrame, features: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Approximate quantiles of each feature; an empty list where it has no values."""
    found = df.agg(*[F.percentile_approx(f, [b / bins for b in range(1, bins)], 1000).alias(f) for f in features]).first()
    return {f: sorted(set(found[f] or [])) for f in features}


def bin_of(feature: str, edges: Sequence[float]) -> Column:
    """The number of edges below a value; null is behind all of them."""
    below = sum(((F.col(feature) > e).cast("int") for e in edges), F.lit(0))
    return F.coalesce(below, F.lit(len(edges) + 1))


def fit(df: DataFrame, y: str, features: Sequence[str], rounds: int = 50, bins: int = 12, rate: float = 0.1, l2: float = 1.0, min_weight: float = 5.0, weight: Column | None = None) -> Model:
    """Fits on the rows with a label. A leaf holds ``min_weight`` or more; leaf values are shrunk by ``l2`` and ``rate``."""
    if (bins + 2) ** len(features) > MOST_CELLS:
        raise ValueError("too many cells: use fewer bins or features")
    labelled = df.where(F.col(y).isNotNull())
    edges = bin_edges(labelled, features, bins)
    w = F.lit(1.0) if weight is None else weight.cast("double")
    cells = labelled.groupBy(*[bin_of(f, edges[f]).alias(f"b{k}") for k, f in enumerate(features)]).agg(F.sum(w).alias("w"), F.sum(w * F.col(y).cast("double")).alias("wy")).toPandas()
    total = cells["w"].sum()
    if not len(cells) or total <= 0:
        return Model(0.0, [])
    at = [cells[f"b{k}"].to_numpy() for k in range(len(features))]
    weights, sums = cells["w"].to_numpy(), cells["wy"].to_numpy()
    base = sums.sum() / total
    guess, stumps = np.full(len(cells), base), []
    for _ in range(rounds):
        residual, best = sums - weights * guess, None
        for k, f in enumerate(features):
            n = len(edges[f])
            own_w, own_r = np.bincount(at[k], weights, n + 2), np.bincount(at[k], residual, n + 2)
            left_w, left_r = np.cumsum(own_w)[:n], np.cumsum(own_r)[:n]
            right_w, right_r = total - left_w, residual.sum() - left_r
            whole = (left_w >= min_weight) & (right_w >= min_weight)
            gain = np.where(whole, left_r**2 / (left_w + l2) + right_r**2 / (right_w + l2), -1.0)
            if n and gain.max() >= 0 and (best is None or gain.max() > best[0] + 1e-12):
                j = int(gain.argmax())
                best = gain[j], k, j, rate * left_r[j] / (left_w[j] + l2), rate * right_r[j] / (right_w[j] + l2)
        if best is None:
            break
        _, k, j, left, right = best
        # a value is at or below edge j exactly if j edges or fewer are below it
        guess = guess + np.where(at[k] <= j, left, right)
        stumps.append((features[k], float(edges[features[k]][j]), float(left), float(right)))
    return Model(float(base), stumps)
