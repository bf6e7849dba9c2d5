"""Whitening of embeddings by upper-triangle column aggregates.

Vectors become integers first, so every sum is exact. One aggregation gives
rows, sums, least and largest entries of each dimension; a second one, of
generated SQL expressions, sums the centred products of every pair of
dimensions, the upper triangle of the covariance. Centres are the whole numbers
nearest to the means; what they miss is put right in integers on the driver,
so the covariance is exact before it is rounded once. LAPACK gives its
eigenvectors, tasks project their rows, and the covariance of what they wrote
is summed by the same expressions, for the error that is reported.

The driver sees sums only: dim * (dim + 1) / 2 numbers, whatever the rows.
Vectors of more than ``PAIRS`` pairs take several aggregations.

Null vectors and vectors with null or non-finite entries, or with an entry that
no exact integer of a double holds (2 to the 53rd, scaled), take no part. Null
ids, repeated ids and rows repeated in full are rows like any other. Vectors of
another length are a fit list of their own; an empty vector has no components.
Dimensions without variance give components whose ``whitened`` and part in
``identity_error`` are null. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import checkpointed

#: Pairs of dimensions that are summed in one aggregation.
PAIRS = 2_600
LARGEST = float(1 << 53)


@dataclass(frozen=True)
class Whitening:
    """A fit: ``n`` rows, whole centres, ``n`` times what the centres miss, unit components (columns) and eigenvalues by falling size, and the covariance's trace."""

    n: int
    centres: list[int]
    missed: list[int]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Which eigenvalues are more than rounding."""
        return self.eigenvalues > max(self.eigenvalues[0], 0.0) * len(self.centres) * np.finfo(float).eps


def integers(df: DataFrame, id_col: str, vector_col: str, scale: float, offset: int) -> DataFrame:
    """(id, x array<long>, dim): floor(scale * c) + offset of every entry of the rows that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    fit = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) + abs(offset) < LARGEST))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), vector.alias("v")).where(F.col("v").isNotNull() & fit)
    return rows.select("id", F.transform("v", lambda c: F.floor(c * scale).cast("long") + F.lit(offset).cast("long")).alias("x"), F.size("v").alias("dim")).where("dim > 0")


def pair_sums(columns: DataFrame, dim: int, kind: str) -> Iterator[tuple[int, int, object]]:
    """(i, j, sum of c_i * c_j) for i <= j, of columns c0, c1, ...: generated SQL expressions, ``PAIRS`` in one aggregation. ``kind`` is the type of a product."""
    pairs = [(i, j) for i in range(dim) for j in range(i, dim)]
    for at in range(0, len(pairs), PAIRS):
        part = pairs[at : at + PAIRS]
        sums = columns.selectExpr(*[f"sum(CAST(c{i} AS {kind}) * c{j}) AS s{i}_{j}" for i, j in part]).first()
        yield from ((i, j, value) for (i, j), value in zip(part, sums, strict=True))


def fit(xs: DataFrame, dim: int) -> Whitening | None:
    """The whitening of the rows (x) of ``dim`` entries; None without rows."""
    each = [(f"sum(CAST(x[{i}] AS decimal(20,0)))", f"min(x[{i}])", f"max(x[{i}])") for i in range(dim)]
    n, *found = xs.selectExpr("count(*)", *[e for own in each for e in own]).first()
    if not n:
        return None
    sums, least, most = ([int(value) for value in found[k::3]] for k in range(3))
    centres = [(2 * s + n) // (2 * n) for s in sums]
    missed = [s - n * c for s, c in zip(sums, centres, strict=True)]
    reach = max(max(c - low, high - c) for c, low, high in zip(centres, least, most, strict=True))
    exact = "bigint" if n * reach * reach < 1 << 62 else "decimal(18,0)"
    centred = xs.selectExpr(*[f"CAST(x[{i}] - {c}L AS {exact}) AS c{i}" for i, c in enumerate(centres)])
    covariance = np.zeros((dim, dim))
    trace = 0
    for i, j, total in pair_sums(centred, dim, exact):
        scatter = n * int(total) - missed[i] * missed[j]
        trace += scatter if i == j else 0
        covariance[i, j] = covariance[j, i] = scatter / (n * n)
    values, vectors = np.linalg.eigh(covariance)
    return Whitening(n, centres, missed, np.ascontiguousarray(vectors[:, ::-1]), values[::-1].copy(), trace / (n * n))


def project(xs: DataFrame, model: Whitening, components: int) -> DataFrame:
    """(id, deviation, w): the exact sum of (n * x - S)^2 (null beyond a long), and the whitened entries, null where there is no variance."""
    n, usable = model.n, model.usable[:components]
    root = np.sqrt(np.where(usable, model.eigenvalues[:components], 1.0))
    axes, k = model.components[:, :components] / root, len(usable)
    centres, missed = np.array(model.centres, np.int64), np.array([m / n for m in model.missed])
    whole = [int(m) for m in model.missed]
    schema = T.StructType([xs.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("w", T.ArrayType(T.DoubleType()))])

    def deviations(d: np.ndarray) -> list[int | None]:
        reach = n * max(abs(int(d.min())), abs(int(d.max()))) + max(map(abs, whole))
        if len(whole) * reach * reach < 1 << 63:
            apart = d * n - np.array(whole, np.int64)
            return (apart * apart).sum(axis=1).tolist()
        sums = [sum((n * value - m) ** 2 for value, m in zip(row, whole, strict=True)) for row in d.tolist()]
        return [s if s < 1 << 63 else None for s in sums]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = np.asarray(batch.column(1).flatten()).reshape(batch.num_rows, -1) - centres
                w = (d - missed) @ axes
                values = pa.array(w.ravel(), mask=np.tile(~usable, len(w)))
                lists = pa.ListArray.from_arrays(np.arange(0, w.size + 1, k, dtype=np.int32), values)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(deviations(d), pa.int64()), lists], names=["id", "deviation", "w"])

    return xs.select("id", "x").mapInArrow(run, schema)


def identity_error(projected: DataFrame, usable: np.ndarray, n: int) -> float | None:
    """The largest absolute entry of the covariance of ``w``, over the usable components, less the identity."""
    places = np.flatnonzero(usable)
    if not len(places):
        return None
    columns = projected.selectExpr(*[f"w[{p}] AS c{k}" for k, p in enumerate(places)])
    means = [total / n for total in columns.selectExpr(*[f"sum(c{k})" for k in range(len(places))]).first()]
    centred = columns.selectExpr(*[f"c{k} - CAST('{mean!r}' AS double) AS c{k}" for k, mean in enumerate(means)])
    return max(abs(total / n - (i == j)) for i, j, total in pair_sums(centred, len(places), "double"))


def whitened(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32, scale: float = 64.0, offset: int = 1_000_000) -> DataFrame:
    """The id, component (from 1, by falling eigenvalue), n, deviation, whitened, explained and identity_error of every row that takes part and every component up to ``components``.

    The projection is written to the shared folder once and read for the error
    and the result. A table whose vectors have several lengths is fitted length
    by length, on the driver's turn: meant for few lengths.
    """
    if not math.isfinite(scale):
        raise ValueError("scale must be finite")
    rows = integers(df, id_col, vector_col, scale, offset)
    new = [T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), *(T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error"))]
    out = df.sparkSession.createDataFrame([], T.StructType([T.StructField(id_col, df.schema[id_col].dataType), *new]))
    for (dim,) in rows.select("dim").distinct().orderBy("dim").collect():
        own = rows.where(F.col("dim") == dim)
        model = fit(own, dim)
        if model is None:
            continue
        projected = checkpointed(project(own, model, components))
        k = min(components, dim)
        error = identity_error(projected, model.usable[:k], model.n)
        explained = F.array(*[F.lit(float(e / model.trace) if model.trace else None).cast("double") for e in model.eigenvalues[:k]])
        each = projected.select("id", "deviation", F.posexplode("w").alias("place", "whitened"))
        found = each.select(F.col("id").alias(id_col), (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened", explained[F.col("place")].alias("explained"), F.lit(error).cast("double").alias("identity_error"))
        out = out.unionByName(found)
    return out
