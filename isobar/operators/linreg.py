"""Least squares by normal equations: the sums are one aggregate, the solve is as small as the number of terms."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sums(y: str, terms: Sequence[str], weight: Column | None) -> tuple[Column, list[Column]]:
    """Whether a row is whole, and the sums of the normal equations."""
    x = [F.lit(1.0), *[F.col(t).cast("double") for t in terms]]
    w = F.lit(1.0) if weight is None else weight
    n = len(x)
    sums = [F.sum(w * x[i] * x[j]).alias(f"a{i}_{j}") for i in range(n) for j in range(i, n)] + [F.sum(w * x[i] * F.col(y)).alias(f"b{i}") for i in range(n)]
    return F.col(y).isNotNull() & ~F.exists(F.array(*x), lambda v: v.isNull() | F.isnan(v)), sums


def _solved(row, n: int, ridge: float) -> list[float]:
    if row["a0_0"] is None:
        return [0.0] * n
    a = np.array([[row[f"a{min(i, j)}_{max(i, j)}"] for j in range(n)] for i in range(n)]) + np.diag([0.0, *[ridge] * (n - 1)])
    return np.linalg.lstsq(a, np.array([row[f"b{i}"] for i in range(n)]), rcond=None)[0].tolist()


def fit(df: DataFrame, y: str, terms: Sequence[str], ridge: float = 0.0, weight: Column | None = None) -> list[float]:
    """Intercept and coefficients; the intercept is not penalised. Rows with a null count for nothing."""
    whole, sums = _sums(y, terms, weight)
    return _solved(df.where(whole).agg(*sums).first(), len(terms) + 1, ridge)


def fit_groups(df: DataFrame, y: str, terms: Sequence[str], by: str, ridge: float = 0.0) -> dict[object, list[float]]:
    """The same for each of the few values of ``by``, in one aggregate."""
    whole, sums = _sums(y, terms, None)
    return {r[by]: _solved(r, len(terms) + 1, ridge) for r in df.where(whole).groupBy(by).agg(*sums).collect()}


def predict(terms: Sequence[str], coefficients: Sequence[float]) -> Column:
    out = F.lit(coefficients[0])
    for term, c in zip(terms, coefficients[1:], strict=True):
        out = out + F.lit(c) * F.col(term)
    return out


def weight_grid(df: DataFrame, y: str, first: str, second: str, segment: str, steps: int = 10, min_rows: int = 60, fallback: float = 0.5) -> DataFrame:
    """Per segment the weight w of ``first`` (1 - w of ``second``) with the least mean absolute error.

    Ties go to the weight nearest 0.5, then to the smaller; segments with fewer
    than ``min_rows`` rows get ``fallback``. All weights are tried in one aggregate.
    """
    weights = [k / steps for k in range(steps + 1)]
    errors = [F.avg(F.abs(w * F.col(first) + (1 - w) * F.col(second) - F.col(y))).alias(f"e{k}") for k, w in enumerate(weights)]
    found = df.where(F.col(y).isNotNull() & F.col(first).isNotNull() & F.col(second).isNotNull()).groupBy(segment).agg(F.count("*").alias("n"), *errors)
    tried = F.array(*[F.struct(F.round(F.col(f"e{k}"), 9).alias("mae"), F.round(F.abs(F.lit(w) - 0.5), 6).alias("off"), F.lit(w).alias("w")) for k, w in enumerate(weights)])
    top = F.array_min(tried)
    return found.select(segment, "n", F.when(F.col("n") >= min_rows, top["w"]).otherwise(fallback).alias("weight"), F.when(F.col("n") >= min_rows, top["mae"]).alias("mae"))
