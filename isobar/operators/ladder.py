"""Quantiles, probability ladders and event bins.

A prediction is a row with one column for each level. A ladder is a long frame
(keys, temp_f, probability), so every step is a window or an aggregate on the
key, and one row's ladder has a few dozen rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed values.
LEVELS = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95)
#: Widths, in standard deviations, of the middle 50 and 90 per cent of a normal distribution.
IQR_Z, P90_Z = 1.3489795003921634, 3.289707253902945
MIN_SIGMA = 0.75


def tag(level: float) -> str:
    return f"q{round(level * 100):02d}"


TAGS = tuple(map(tag, LEVELS))


def rearranged(columns: Sequence[str]) -> list[Column]:
    """Each quantile with the largest of those before it: monotone, in order."""
    return [F.greatest(*[F.col(c) for c in columns[: k + 1]]).alias(name) if k else F.col(name) for k, name in enumerate(columns)]


def crossings(columns: Sequence[str]) -> list[Column]:
    """Counts of rows in which a quantile is below the one before it, by pair and at all."""
    below = [F.col(b) < F.col(a) for a, b in zip(columns, columns[1:], strict=False)]
    any_below = below[0]
    for b in below[1:]:
        any_below = any_below | b
    return [F.count_if(b).alias(f"crossed_{a}_{c}") for b, a, c in zip(below, columns, columns[1:], strict=False)] + [F.count_if(any_below).alias("crossed_any")]


def phi(x: Column) -> Column:
    """Normal distribution function: a rational approximation with an error below 7.5e-8."""
    t = 1.0 / (1.0 + 0.2316419 * F.abs(x))
    tail = F.exp(-x * x / 2.0) / math.sqrt(2 * math.pi) * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(x >= 0, 1.0 - tail).otherwise(tail)


def with_bounds(df: DataFrame, columns: Sequence[str] = TAGS, margin: int = 8) -> DataFrame:
    """low and high: whole degrees around each row's own quantiles."""
    values = [F.col(c) for c in columns]
    return df.withColumns({"low": F.floor(F.least(*values)).cast("int") - margin, "high": F.ceil(F.greatest(*values)).cast("int") + margin})


def common_bounds(df: DataFrame, columns: Sequence[str] = TAGS, observed: str | None = None, margin: int = 8) -> DataFrame:
    """low and high, the same for all rows: whole degrees around all quantiles and observed values. One aggregate; its one row is sent to all."""
    values = [F.col(c).cast("double") for c in (*columns, *([observed] if observed else []))]
    ends = df.agg(F.min(F.least(*values)).alias("__low"), F.max(F.greatest(*values)).alias("__high"))
    return df.crossJoin(F.broadcast(ends)).withColumns({"low": F.floor(F.col("__low") - margin).cast("int"), "high": F.ceil(F.col("__high") + margin).cast("int")}).drop("__low", "__high")


def _cdf(at: Column, columns: Sequence[str], levels: Sequence[float]) -> Column:
    """Piecewise linear through (quantile, level), of equal quantiles the largest level, clamped to the end levels. Steps between levels are of decimals, without the noise of their doubles."""
    first, last = F.col(columns[0]), F.col(columns[-1])
    pairs = [(F.col(c), F.lit(level)) for c, level in zip(columns, levels, strict=True)]
    # The largest quantile at most `at` starts the piece, with the largest level of all that are; the next larger quantile ends it.
    left_x, left_p = (F.greatest(*[F.when(c <= at, (c, level)[k]) for c, level in pairs]) for k in (0, 1))
    right_x = F.least(*[F.when(c > at, c) for c, _ in pairs])
    right_p = F.greatest(*[F.when(c == right_x, level) for c, level in pairs])
    first_p = F.lit(levels[0])
    for later, level in zip(columns[1:], levels[1:], strict=True):
        first_p = F.when(F.col(later) == first, F.lit(level)).otherwise(first_p)
    return F.when(at < first, first_p).when(at >= last, F.lit(levels[-1])).otherwise(left_p + (at - left_x) * F.round(right_p - left_p, 12) / (right_x - left_x))


def interpolated_ladder(df: DataFrame, keys: Sequence[str], columns: Sequence[str] = TAGS, levels: Sequence[float] = LEVELS) -> DataFrame:
    """Ladder from rearranged quantiles by a piecewise linear distribution; needs low and high.

    Mass below the first quantile is shared by the degrees below it (or goes to
    the first degree), and so above the last. Equal quantiles throughout put all
    mass on one degree, half to even. The sum is one.
    """
    first, last = F.col(columns[0]), F.col(columns[-1])
    rows = df.select(*keys, *columns, "low", "high", F.explode(F.sequence("low", "high")).alias("temp_f"))
    t = F.col("temp_f").cast("double")
    first_level = F.lit(levels[0])
    for later, level in zip(columns[1:], levels[1:], strict=True):
        first_level = F.when(F.col(later) == first, F.lit(level)).otherwise(first_level)
    n_below = F.greatest(F.lit(0), F.least(F.col("high") - F.col("low") + 1, F.ceil(first).cast("int") - F.col("low")))
    n_above = F.greatest(F.lit(0), F.least(F.col("high") - F.col("low") + 1, F.col("high") - F.floor(last).cast("int")))
    lower = F.when(n_below > 0, F.when(t < first, first_level / n_below).otherwise(0.0)).otherwise(F.when(F.col("temp_f") == F.col("low"), first_level).otherwise(0.0))
    rest = round(1.0 - levels[-1], 12)
    upper = F.when(n_above > 0, F.when(t > last, F.lit(rest) / n_above).otherwise(0.0)).otherwise(F.when(F.col("temp_f") == F.col("high"), F.lit(rest)).otherwise(0.0))
    middle = F.greatest(_cdf(t + 0.5, columns, levels) - _cdf(t - 0.5, columns, levels), F.lit(0.0))
    point = F.least(F.greatest(F.bround(first, 0).cast("int"), F.col("low")), F.col("high"))
    mass = F.when(first == last, F.when(F.col("temp_f") == point, 1.0).otherwise(0.0)).otherwise(middle + lower + upper)
    return normalised(rows.select(*keys, "temp_f", mass.alias("probability")), keys)


def normal_ladder(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Ladder of a normal distribution around q50 with the width of the quantiles; needs low and high."""
    a, b = (F.col("q75") - F.col("q25")) / IQR_Z, (F.col("q95") - F.col("q05")) / P90_Z
    middle = F.when((a > 0) & (b > 0), (a + b) / 2).when(a > 0, a).when(b > 0, b)
    sigma = F.greatest(F.coalesce(middle, F.lit(MIN_SIGMA)), F.lit(MIN_SIGMA))
    rows = df.select(*keys, "q50", sigma.alias("sigma"), F.explode(F.sequence("low", "high")).alias("temp_f"))
    mass = phi((F.col("temp_f") + 0.5 - F.col("q50")) / F.col("sigma")) - phi((F.col("temp_f") - 0.5 - F.col("q50")) / F.col("sigma"))
    return normalised(rows.select(*keys, "temp_f", mass.alias("probability")), keys)


def _by_degree(keys: Sequence[str]) -> WindowSpec:
    """All rows of a key, in the order of degrees: sums over it have the same last bit in every run."""
    return Window.partitionBy(*keys).orderBy("temp_f").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def normalised(ladder: DataFrame, keys: Sequence[str], out: str = "probability") -> DataFrame:
    """Probabilities over their sum, taken by degree whatever the order of the rows; uniform where the sum is not positive."""
    window = _by_degree(keys)
    total = F.sum(out).over(window)
    return ladder.withColumn("__total", total).withColumn("__n", F.count("*").over(window)).withColumn(out, F.when(F.col("__total") > 0, F.col(out) / F.col("__total")).otherwise(1.0 / F.col("__n"))).drop("__total", "__n")


def smoothed(ladder: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Convolved with .25, .5, .25; ends repeat themselves."""
    window = Window.partitionBy(*keys).orderBy("temp_f")
    p = F.col("probability")
    around = 0.25 * F.coalesce(F.lag(p).over(window), p) + 0.5 * p + 0.25 * F.coalesce(F.lead(p).over(window), p)
    return normalised(ladder.withColumn("probability", around), keys)


def widened(ladder: DataFrame, keys: Sequence[str], width: float, only: Column | None = None) -> DataFrame:
    """Convolved with a Gaussian of ``width`` degrees, edges repeated; where ``only`` holds."""
    radius = max(1, math.ceil(3 * width))
    weights = [math.exp(-0.5 * (d / width) ** 2) for d in range(-radius, radius + 1)]
    total = sum(weights)
    window = Window.partitionBy(*keys).orderBy("temp_f")
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    p, first, last = F.col("probability"), F.first("probability").over(whole), F.last("probability").over(whole)
    around = F.lit(0.0)
    for d, w in zip(range(-radius, radius + 1), weights, strict=True):
        beside = F.coalesce(F.lag(p, -d).over(window), first) if d < 0 else F.coalesce(F.lead(p, d).over(window), last)
        around = around + (w / total) * beside
    mass = around if only is None else F.when(only, around).otherwise(p)
    return normalised(ladder.withColumn("probability", mass), keys)


def truncated(ladder: DataFrame, keys: Sequence[str], so_far: str) -> DataFrame:
    """No mass below what has been reached; renormalised if any is left."""
    cut = ladder.withColumn("probability", F.when(F.col("temp_f") < F.col(so_far), 0.0).otherwise(F.col("probability")))
    total = F.sum("probability").over(_by_degree(keys))
    return cut.withColumn("probability", F.when(total > 0, F.col("probability") / total).otherwise(0.0))


def bin_mass(ladder: DataFrame, bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Mass of each bin (name, lower, upper; closed, null for open). ``bins`` is a small, given table."""
    inside = (F.col("lower").isNull() | (F.col("temp_f") >= F.col("lower"))) & (F.col("upper").isNull() | (F.col("temp_f") <= F.col("upper")))
    return ladder.join(F.broadcast(bins), inside).groupBy(*keys, "name").agg(F.sum("probability").alias("probability"))


def cumulative(ladder: DataFrame, keys: Sequence[str]) -> DataFrame:
    return ladder.withColumn("cdf", F.sum("probability").over(Window.partitionBy(*keys).orderBy("temp_f").rowsBetween(Window.unboundedPreceding, 0)))


def expected(keys: Sequence[str], ladder: DataFrame) -> DataFrame:
    return ladder.groupBy(*keys).agg(F.sum(F.col("temp_f") * F.col("probability")).alias("expected_f"))
