"""Neighbourhood statistics of cells on a grid.

Two forms: a cell table (keys, row, col, value), where cells meet their
neighbours by an equi-join on explicit offsets, and arrays (one grid a row).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def at_points(cells: DataFrame, points: DataFrame, keys: Sequence[str], radius: int, north_is_first: bool = True) -> DataFrame:
    """For each point (keys, row, col): mean, min, max, population deviation and gradients of the cells at most ``radius`` away.

    The window is clipped at the grid's edges; missing cells do not count. The
    west-east gradient is the mean of the last column less that of the first,
    the south-north one that of the northern row less the southern one.
    """
    offsets = F.sequence(F.lit(-radius), F.lit(radius))
    wanted = points.select(*keys, F.col("row").alias("at_row"), F.col("col").alias("at_col"), F.explode(offsets).alias("__dr")).withColumn("__dc", F.explode(offsets))
    wanted = wanted.select(*keys, "at_row", "at_col", (F.col("at_row") + F.col("__dr")).alias("row"), (F.col("at_col") + F.col("__dc")).alias("col"))
    inside = wanted.join(cells.where(F.col("value").isNotNull() & ~F.isnan("value")), [*keys, "row", "col"])
    r, c, v = F.col("row"), F.col("col"), F.col("value")
    edges = inside.groupBy(*keys, "at_row", "at_col").agg(F.min("row").alias("__r0"), F.max("row").alias("__r1"), F.min("col").alias("__c0"), F.max("col").alias("__c1"))
    joined = inside.join(edges, [*keys, "at_row", "at_col"])
    north, south = ("__r0", "__r1") if north_is_first else ("__r1", "__r0")
    return joined.groupBy(*keys, "at_row", "at_col").agg(
        F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_pop(v).alias("std"), F.count(v).alias("n"),
        (F.avg(F.when(c == F.col("__c1"), v)) - F.avg(F.when(c == F.col("__c0"), v))).alias("west_east"),
        (F.avg(F.when(r == F.col(north), v)) - F.avg(F.when(r == F.col(south), v))).alias("south_north"),
    )


def array_window(grid: Column, width: int, height: int, row: int, col: int, radius: int) -> dict[str, Column]:
    """The same for one place of a row-major array: mean, min, max, std, west_east and south_north, in the JVM."""
    rows = range(max(0, row - radius), min(height, row + radius + 1))
    cols = range(max(0, col - radius), min(width, col + radius + 1))

    def values(rs: Sequence[int], cs: Sequence[int]) -> Column:
        return F.filter(F.array(*[F.try_element_at(grid, F.lit(r * width + c + 1)).cast("double") for r in rs for c in cs]), lambda v: v.isNotNull() & ~F.isnan(v))

    def mean(a: Column) -> Column:
        return F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda s, v: s + v) / F.size(a))

    window = values(rows, cols)
    middle = mean(window)
    squares = F.aggregate(F.transform(window, lambda v: (v - middle) * (v - middle)), F.lit(0.0), lambda s, v: s + v)
    return {
        "mean": middle, "min": F.array_min(window), "max": F.array_max(window), "std": F.when(F.size(window) > 0, F.sqrt(squares / F.size(window))),
        "west_east": mean(values(rows, cols[-1:])) - mean(values(rows, cols[:1])), "south_north": mean(values(rows[:1], cols)) - mean(values(rows[-1:], cols)),
    }


def to_180(lon: Column) -> Column:
    """Longitudes of 0..360 as -180..180."""
    return F.when(lon > 180, lon - 360.0).otherwise(lon)


def longitude_convention(lon: Column) -> Column:
    """An aggregate: 0-360 if any longitude is above 180, else -180..180; unknown without any."""
    top = F.max(F.nanvl(lon, F.lit(None)))
    return F.when(top.isNull(), "unknown").when(top > 180, "0-360").otherwise("-180..180")


def in_convention(lon: Column, convention: Column) -> Column:
    """A place's longitude as a grid of that convention has it."""
    return F.when((convention == "0-360") & (lon < 0), lon + 360.0).otherwise(lon)


def orientation(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """north_is_first and west_is_first of each grid (keys, row, col, lat, lon): by the means of its outer rows and columns."""
    ends = cells.groupBy(*keys).agg(F.min("row").alias("__r0"), F.max("row").alias("__r1"), F.min("col").alias("__c0"), F.max("col").alias("__c1"))

    def mean(value: str, at: str, end: str) -> Column:
        return F.avg(F.when(F.col(at) == F.col(end), F.col(value)))

    found = cells.join(F.broadcast(ends), list(keys)) if keys else cells.crossJoin(F.broadcast(ends))
    return found.groupBy(*keys).agg((mean("lat", "row", "__r0") >= mean("lat", "row", "__r1")).alias("north_is_first"), (mean("lon", "col", "__c0") <= mean("lon", "col", "__c1")).alias("west_is_first"))


def nearest_cell(cells: DataFrame, points: DataFrame, point_keys: Sequence[str], degrees: float = 0.5) -> DataFrame:
    """For each point (keys, lat, lon) the nearest cell (row, col, lat, lon) by squared degrees, over the date line too; of equals the first by row and column.

    Both are dealt to boxes of ``degrees``; a point looks at its own box and the
    eight around it, where any cell within ``degrees`` must be. Points whose
    nearest cell there is further, or that find none, look again in boxes twice
    as large, at last in one that holds everything. Without cells a point has
    nulls.
    """
    west = lambda x: F.pmod(x + 180.0, F.lit(360.0)) - 180.0
    found = None
    grid = cells.select("row", "col", F.col("lat").alias("cell_lat"), F.col("lon").alias("cell_lon"), west(F.col("lon")).alias("__lon"))
    # a place is searched for once, however many points it has
    left = points.select("lat", "lon").distinct().select("lat", "lon", west(F.col("lon")).alias("__west"))
    size = degrees
    while True:
        last = size >= 180
        columns = 1 if last else math.floor(360 / size)
        wide = 360.0 / columns

        def box(lat: Column, lon: Column, wide: float = wide, size: float = size, last: bool = last) -> tuple[Column, Column]:
            return (F.lit(0).cast("long"), F.lit(0).cast("long")) if last else (F.floor(lat / size), F.floor((lon + 180.0) / wide))

        around = [0] if last else [-1, 0, 1]
        y, x = box(F.col("lat"), F.col("__west"))
        near = [F.struct((y + dy).alias("__y"), F.pmod(x + dx, F.lit(columns).cast("long")).alias("__x")) for dy in around for dx in around]
        cy, cx = box(F.col("cell_lat"), F.col("__lon"))
        wanted = left.withColumn("__b", F.explode(F.array_distinct(F.array(*near)))).select(*left.columns, "__b.*")
        met = wanted.join(grid.withColumns({"__y": cy, "__x": cx}), ["__y", "__x"])
        apart = F.abs(F.col("__west") - F.col("__lon"))
        apart = F.least(apart, 360.0 - apart)
        scored = met.withColumn("distance2", F.pow(F.col("lat") - F.col("cell_lat"), 2) + apart * apart)
        best = scored.groupBy(*left.columns).agg(F.min(F.struct(F.round("distance2", 9).alias("rounded"), "row", "col", "distance2", "cell_lat", "cell_lon")).alias("__near"))
        out = left.join(best, left.columns, "left")
        sure = F.lit(True) if last else F.coalesce(F.col("__near.distance2") <= size * size, F.lit(False))
        done = out.where(sure).select("lat", "lon", "__near.distance2", "__near.row", "__near.col", "__near.cell_lat", "__near.cell_lon")
        found = done if found is None else found.unionByName(done)
        if last:
            break
        left, size = out.where(~sure).select(left.columns), size * 8
    near = found.withColumnsRenamed({"lat": "__lat", "lon": "__lon"})
    met = points.join(near, F.col("lat").eqNullSafe(F.col("__lat")) & F.col("lon").eqNullSafe(F.col("__lon")), "left")
    return met.select(*point_keys, "distance2", "row", "col", "cell_lat", "cell_lon")
