"""Grids in tiles: windows read from only the tiles they touch, and stencils of tiles with a halo.

A tile is ``SIZE`` by ``SIZE`` cells and has a Morton code, so tiles that lie
near one another are stored near one another. Tiles are written in chunks of
``CHUNK`` by ``CHUNK`` tiles, one folder each, sorted by code: folders that a
window does not touch are not read, nor row groups with other codes.

Cells are (keys, row, col, value) with rows and columns from 0 to 2^31 - 1.
Where a cell is there more than once the largest value counts; null values and
NaN are cells that are missing. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIZE, CHUNK = 16, 16
#: Chunks that are named in the scan itself; beyond that many, windows and cells are joined without it.
NAMED_CHUNKS = 10_000


def morton(row: Column, col: Column) -> Column:
    """The bits of row and col (31 at most) in turn, col's lowest first."""
    def spread(x: Column) -> Column:
        x = x.cast("long")
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return x

    return F.shiftleft(spread(row), 1).bitwiseOR(spread(col))


def _of(place: Column, size: int) -> Column:
    return F.floor(place / size).cast("long")


def write_tiles(cells: DataFrame, path: str, size: int = SIZE, chunk: int = CHUNK) -> None:
    """``cells`` below ``path``, a folder a chunk; a chunk with very many cells is split between tasks."""
    tile = morton(_of(F.col("row"), size), _of(F.col("col"), size))
    rows = cells.where(F.col("value").isNotNull() & ~F.isnan("value")).withColumns({"tile": tile, "chunk": morton(_of(F.col("row"), size * chunk), _of(F.col("col"), size * chunk))})
    rows.hint("rebalance", "chunk").sortWithinPartitions("chunk", "tile").write.partitionBy("chunk").parquet(path)


def in_windows(spark: SparkSession, path: str, schema: T.StructType, windows: DataFrame, keys: Sequence[str] = (), size: int = SIZE, chunk: int = CHUNK) -> DataFrame:
    """The columns of ``windows`` (row0, row1, col0, col1, closed, and ``keys`` of the grid) and row, col and value of the cells inside; windows without cells give none.

    ``schema`` is that of the cells. Each window is dealt to the tiles that it
    touches, and meets their cells by equality.
    """
    def span(low: str, high: str) -> Column:
        return F.sequence(_of(F.greatest(F.col(low), F.lit(0)), size), _of(F.col(high), size))

    there = windows.where("row0 <= row1 AND col0 <= col1 AND row1 >= 0 AND col1 >= 0")
    dealt = there.withColumn("__tr", F.explode(span("row0", "row1"))).withColumn("__tc", F.explode(span("col0", "col1")))
    dealt = dealt.withColumns({"tile": morton(F.col("__tr"), F.col("__tc")), "chunk": morton(_of(F.col("__tr"), chunk), _of(F.col("__tc"), chunk))}).drop("__tr", "__tc")
    stored = T.StructType([*schema.fields, T.StructField("tile", T.LongType()), T.StructField("chunk", T.LongType())])
    cells = spark.read.schema(stored).parquet(path)
    named = [r.chunk for r in dealt.select("chunk").distinct().limit(NAMED_CHUNKS + 1).collect()]
    if len(named) <= NAMED_CHUNKS:
        cells = cells.where(F.col("chunk").isin(named)) if named else cells.where(F.lit(False))
    met = dealt.join(cells, [*keys, "chunk", "tile"]).where("row BETWEEN row0 AND row1 AND col BETWEEN col0 AND col1")
    return met.groupBy(*windows.columns, "row", "col").agg(F.max("value").alias("value"))


def _window_sums(grid: np.ndarray, radius: int) -> np.ndarray:
    """The sum over each full window, by prefix sums in both directions."""
    width = 2 * radius + 1
    sums = np.pad(grid, ((1, 0), (1, 0))).cumsum(axis=0).cumsum(axis=1)
    return sums[width:, width:] - sums[:-width, width:] - sums[width:, :-width] + sums[:-width, :-width]


def _window_best(grid: np.ndarray, radius: int, best: np.ufunc) -> np.ndarray:
    """The least or largest value of each full window, one direction after the other."""
    width = 2 * radius + 1
    rows = best.reduce([grid[k : len(grid) - width + 1 + k] for k in range(width)])
    return best.reduce([rows[:, k : rows.shape[1] - width + 1 + k] for k in range(width)])


def stencil(cells: DataFrame, keys: Sequence[str], radius: int, size: int = 64) -> DataFrame:
    """keys, row, col, n, mean, min, max and std (population) of the cells at most ``radius`` away, for every cell that is there.

    A cell goes to its own tile and to those whose halo holds it, in one
    shuffle; a task holds one tile and its halo. Sums are taken about the
    tile's mean, so they lose no digits.
    """
    if radius > size:
        raise ValueError("the halo must not be wider than a tile")
    kept = cells.where(F.col("value").isNotNull() & ~F.isnan("value"))

    def around(place: str) -> Column:
        return F.array_distinct(F.array(*[_of(F.col(place) + d, size) for d in (-radius, 0, radius)]))

    dealt = kept.select(*keys, F.col("row").cast("long").alias("row"), F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))
    dealt = dealt.withColumn("__tr", F.explode(around("row"))).withColumn("__tc", F.explode(around("col")))
    schema = T.StructType([*(cells.schema[k] for k in keys), *(T.StructField(c, T.LongType()) for c in ("row", "col", "n")), *(T.StructField(c, T.DoubleType()) for c in ("mean", "min", "max", "std"))])

    def tile(group: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        row0, col0 = int(group[-2]) * size - radius, int(group[-1]) * size - radius
        side = size + 2 * radius
        frame = frame.groupby(["row", "col"], as_index=False)["value"].max()
        r, c, v = frame["row"].to_numpy() - row0, frame["col"].to_numpy() - col0, frame["value"].to_numpy()
        there, values, middle = np.zeros((side, side)), np.zeros((side, side)), v.mean()
        there[r, c], values[r, c] = 1, v - middle
        own = (r >= radius) & (r < radius + size) & (c >= radius) & (c < radius + size)
        at = r[own] - radius, c[own] - radius
        n = _window_sums(there, radius)[at]
        mean = _window_sums(values, radius)[at] / n
        spread = np.maximum(_window_sums(values**2, radius)[at] / n - mean**2, 0)
        least = _window_best(np.where(there > 0, values, np.inf), radius, np.minimum)[at]
        most = _window_best(np.where(there > 0, values, -np.inf), radius, np.maximum)[at]
        names = {k: group[i] for i, k in enumerate(keys)}
        return pd.DataFrame({**names, "row": frame["row"].to_numpy()[own], "col": frame["col"].to_numpy()[own], "n": n.astype(np.int64), "mean": mean + middle, "min": least + middle, "max": most + middle, "std": np.sqrt(spread)})

    return dealt.groupBy(*keys, "__tr", "__tc").applyInPandas(tile, schema)
