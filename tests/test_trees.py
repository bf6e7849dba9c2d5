"""Boosted quantile trees: what stumps cannot fit, and loss on rows that were held out."""

from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from isobar.operators import quantile_gbm, trees


def _rows(seed, n):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        a, b = rng.uniform(-1, 1), rng.choice([None, rng.uniform(-1, 1)]) if rng.random() < 0.1 else rng.uniform(-1, 1)
        out.append((k, a, b, rng.random(), 10.0 * ((a > 0) != ((b if b is not None else 1) > 0)) + rng.gauss(0, 1)))
    return out


def _loss(rows, model, level):
    return rows.select(F.avg(F.greatest(level * (F.col("y") - model.predict(level)), (level - 1) * (F.col("y") - model.predict(level)))).alias("l")).first().l


def test_an_interaction_that_stumps_cannot_fit(spark):
    schema = "k int, a double, b double, c double, y double"
    train, held = spark.createDataFrame(_rows(1, 3000), schema), spark.createDataFrame(_rows(2, 1500), schema)
    how = {"levels": (0.1, 0.5, 0.9), "rounds": 3, "rate": 0.6, "bins": 8}
    deep = quantile_gbm.fit(train, "y", ["a", "b", "c"], depth=3, **how)
    stumps = quantile_gbm.fit(train, "y", ["a", "b", "c"], depth=1, **how)
    for level in how["levels"]:
        assert _loss(held, deep, level) < 0.7 * _loss(held, stumps, level), level
    share = held.select(F.avg((F.col("y") <= deep.predict(0.9)).cast("double")).alias("s")).first().s
    assert 0.8 < share < 0.97
    assert all(isinstance(tree, tuple) for tree in deep.trees[0.5])


def test_no_rows_constant_features_and_few_rows(spark):
    schema = "k int, a double, b double, c double, y double"
    empty = quantile_gbm.fit(spark.createDataFrame([], schema), "y", ["a"], levels=(0.5,), rounds=2)
    assert empty.predict(0.5) is not None and empty.trees == {}
    same = spark.createDataFrame([(k, 1.0, None, 0.0, float(k)) for k in range(20)], schema)
    flat = quantile_gbm.fit(same, "y", ["a", "b"], levels=(0.5,), rounds=2)
    assert flat.trees[0.5] == [] and flat.base[0.5] == 9.5


def test_a_split_has_the_largest_gain():
    rng = np.random.default_rng(4)
    count, total = rng.integers(0, 9, 12).astype(float), rng.normal(size=12) * 5
    gain, edge = trees.best_split(count, total, 10, 3)
    options = []
    for j in range(10):
        n, g = count[: j + 1].sum(), total[: j + 1].sum()
        if n >= 3 and count.sum() - n >= 3:
            options.append((g * g / n + (total.sum() - g) ** 2 / (count.sum() - n) - total.sum() ** 2 / count.sum(), -j))
    assert math.isclose(gain, max(options)[0]) and edge == -max(options)[1]
    assert trees.best_split(np.ones(3), np.ones(3), 1, 50) is None and trees.best_split(np.ones(2), np.ones(2), 0, 0) is None
