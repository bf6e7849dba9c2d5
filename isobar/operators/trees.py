"""Regression trees as columns, and the choice of their splits from histograms.

A tree is a leaf (a number) or (feature, threshold, left, right): values at or
below the threshold go left, all others and nulls right.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

Tree = float | tuple


def as_column(tree: Tree, feature: Callable[[str], Column] = F.col) -> Column:
    """The tree's value of a row."""
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    name, threshold, left, right = tree
    return F.when(feature(name) <= threshold, as_column(left, feature)).otherwise(as_column(right, feature))


def best_split(count: np.ndarray, total: np.ndarray, edges: int, least: float, shrink: float = 0.0) -> tuple[float, int] | None:
    """(gain, edge) of the split of one feature's bins with the largest gain in squared sums; None if no side may hold ``least``.

    ``count`` and ``total`` are by bin; bins 0..edge go left.
    """
    if not edges:
        return None
    n, g = np.cumsum(count)[:edges], np.cumsum(total)[:edges]
    n_all, g_all = count.sum(), total.sum()
    fits = (n >= least) & (n_all - n >= least)
    if not fits.any():
        return None
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(fits, g**2 / (n + shrink) + (g_all - g) ** 2 / (n_all - n + shrink), -np.inf)
    j = int(gain.argmax())
    return float(gain[j] - g_all**2 / (n_all + shrink)), j
