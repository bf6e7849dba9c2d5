"""Choices among candidates, and greedy takes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = ()) -> DataFrame:
    """The first candidate of each group."""
    if not by:
        return df.orderBy(*order).limit(1)
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where("__rank = 1").drop("__rank")


def guarded(df: DataFrame, loss: str, slice_loss: str, order: Sequence[str], tolerance: float = 0.005, gain: float = 0.02) -> DataFrame:
    """Among candidates within ``tolerance`` of the best loss, the one best on the slice, if better there by ``gain``; else the best."""
    top = best(df, [loss, *order])
    bound = top.select(F.col(loss).alias("__best"), F.col(slice_loss).alias("__slice"))
    near = df.crossJoin(F.broadcast(bound)).where((F.col(loss) <= F.col("__best") + tolerance) & (F.col(slice_loss) <= F.col("__slice") - gain)).drop("__best", "__slice")
    chosen = near.withColumn("__tier", F.lit(0)).unionByName(top.withColumn("__tier", F.lit(1)))
    return chosen.orderBy("__tier", F.when(F.col("__tier") == 0, F.col(slice_loss)), loss, *order).limit(1).drop("__tier")


def guarded_against(df: DataFrame, baseline: Column, limits: dict[str, tuple[str, float]], order: Sequence[Column | str]) -> DataFrame:
    """The first candidate that keeps every limit against the baseline row; the baseline if none does.

    ``limits``: metric -> ("le" or "ge", slack), the candidate's value against
    the baseline's plus the slack.
    """
    base = df.where(baseline).limit(1).select(*[F.col(m).alias(f"__base_{m}") for m in limits])
    kept = df.crossJoin(F.broadcast(base))
    for metric, (side, slack) in limits.items():
        bound = F.col(f"__base_{metric}") + slack
        kept = kept.where(baseline | (F.col(metric) <= bound if side == "le" else F.col(metric) >= bound))
    return kept.withColumn("__base", baseline).orderBy("__base", *order).limit(1).drop("__base", *[f"__base_{m}" for m in limits])


def running_take(df: DataFrame, by: Sequence[str], price: str, size: str, wanted: float, max_slippage: float, tie: Sequence[str]) -> DataFrame:
    """Fills an order from the best price down: offers within ``max_slippage`` of the best one, until ``wanted`` is taken.

    Adds filled, the part of each offer taken; offers beyond are left out. The
    best prices are aggregated first, so only offers within reach are sorted.
    """
    order = Window.partitionBy(*by).orderBy(F.desc(price), *tie)
    top = df.groupBy(*[F.col(c).alias(f"__by_{c}") for c in by]).agg(F.max(price).alias("__top"))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"__by_{c}")) for c in by])
    reachable = df.join(top, same).drop(*[f"__by_{c}" for c in by]).where(F.col(price) >= F.col("__top") - max_slippage)
    before = F.coalesce(F.sum(size).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return reachable.withColumn("__before", before).where(F.col("__before") < wanted).withColumn("filled", F.least(F.col(size), F.lit(wanted) - F.col("__before"))).drop("__top", "__before")


def preferred(df: DataFrame, by: Sequence[str], field: str, preferences: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """Of each group the row whose ``field`` stands first in ``preferences``; rows with other values are left out."""
    place = F.array_position(F.array(*map(F.lit, preferences)), F.col(field))
    return best(df.withColumn("preference", place).where("preference > 0"), ["preference", *order], by)


def preferred_levels(records: DataFrame, levels: dict[str, Sequence[str]], required: Sequence[str]) -> DataFrame:
    """A row for each field of ``levels``: its record and level, and how it was found.

    Records (field, level, extra, record): the level that stands first counts,
    then records without further text (exact) before those with it (fallback),
    then the first record; records of an ensemble or of a percentile are left
    out. A field without a record is missing required or missing optional.
    """
    wanted = records.sparkSession.createDataFrame([(f, level, k, f in required) for f, own in levels.items() for k, level in enumerate(own)], "field string, level string, preference int, required boolean")
    plain = records.where(~F.rlike("extra", F.lit("ens|%")))
    met = F.broadcast(wanted).join(plain, ["field", "level"], "left")
    exact = F.coalesce(F.col("extra"), F.lit("")) == ""
    first = F.min(F.when(F.col("record").isNotNull(), F.struct("preference", (~exact).alias("fallback"), "record", "level"))).alias("__first")
    found = met.groupBy("field").agg(first, F.bool_or("required").alias("required"))
    missing = F.when(F.col("required"), "missing required").otherwise("missing optional")
    status = F.when(F.col("__first").isNull(), missing).when(F.col("__first.fallback"), "fallback").otherwise("exact")
    return found.select("field", "__first.level", "__first.record", status.alias("status"))


def name_of_least(names: Sequence[str], greatest: bool = False) -> Column:
    """The name of the least (or greatest) of the columns, the first of equals; null where all are."""
    top = (F.greatest if greatest else F.least)(*[F.col(n) for n in names])
    return F.coalesce(*[F.when(F.col(n) == top, n) for n in names])


def best_hours(df: DataFrame, loss: str, rows: str, tie: Sequence[str], n: int) -> DataFrame:
    """The ``n`` groups of least loss; of equals (to nine digits) those of more rows."""
    return df.orderBy(F.round(loss, 9), F.desc(rows), *tie).limit(n)


def top_members(ranked: DataFrame, loss: Sequence[str], member: str, sizes: Sequence[int] = (2, 3, 5)) -> DataFrame:
    """A row for each ensemble size and member: the best ``size`` candidates; sizes that there are too few for are left out."""
    placed = ranked.withColumn("__place", F.row_number().over(Window.orderBy(*loss, member)))
    total = ranked.agg(F.count("*").alias("__total"))
    sized = placed.crossJoin(F.broadcast(total)).select(F.explode(F.array(*map(F.lit, sizes))).alias("size"), "*")
    return sized.where((F.col("size") <= F.col("__total")) & (F.col("__place") <= F.col("size"))).select("size", member, F.col("__place").alias("place"))


def promoted(summary: DataFrame, slices: DataFrame, method: str, baseline: str, order: Sequence[str], watched: Sequence[str], value: str, max_drop: float, gain: str | None = None, min_gain: float = 0.0) -> DataFrame:
    """The best candidate that drops ``value`` on none of the ``watched`` slices by more than ``max_drop`` against the baseline; the baseline at the latest.

    ``slices``: method, slice, value (and ``gain``, a loss: a drop over all rows
    is forgiven where it falls by ``min_gain`` or more). A slice that either
    lacks does not count. One row: the method, and how many better ones were
    rejected.
    """
    base = slices.where(F.col(method) == baseline).select("slice", F.col(value).alias("__base"), *([F.col(gain).alias("__gain")] if gain else []))
    against = slices.where(F.col(method) != baseline).join(F.broadcast(base), "slice")
    drop = (F.col("__base") - F.col(value)) > max_drop
    overall = F.col("slice") == "overall"
    broken = drop & (F.col("slice").isin(*watched) | ((overall & (F.col("__gain") - F.col(gain) < min_gain)) if gain else F.lit(False)))
    bad = against.groupBy(method).agg(F.bool_or(broken).alias("__bad"))
    placed = summary.join(F.broadcast(bad), method, "left").withColumn("__bad", F.coalesce("__bad", F.lit(False)) & (F.col(method) != baseline))
    ranked = placed.withColumn("__place", F.row_number().over(Window.orderBy(*order, method)))
    first = F.min(F.when(~F.col("__bad"), F.struct("__place", method))).alias("__first")
    found = ranked.agg(first, F.collect_list(F.when(F.col("__bad"), F.col("__place"))).alias("__rejected"))
    return found.select(F.coalesce(F.col(f"__first.{method}"), F.lit(baseline)).alias(method), F.size(F.filter("__rejected", lambda p: p < F.col("__first.__place"))).cast("long").alias("rejected"))


#: Names of levels that have a height, and the words of a step that tell how it was summed up.
LEVEL_HEIGHTS = {"2 m above ground": 2, "10 m above ground": 10}
STEP_KINDS = {"acc": "accum", "avg": "avg", "max": "max", "min": "min"}


def step_kind(step: Column) -> Column:
    """How a record's values are summed up over its step; instant if no word tells."""
    words = F.split(F.lower(step), " ")
    return F.coalesce(*[F.when(F.array_contains(words, word), kind) for word, kind in STEP_KINDS.items()], F.lit("instant"))


def matched_rasters(records: DataFrame, rasters: DataFrame, by: Sequence[str]) -> DataFrame:
    """Each raster (``by``, raster, short, height, step_kind) with the records (``by``, record, short, level, step) that it may hold: ``by``, raster, record.

    Names must agree, whatever their case; a height or kind that the raster
    does not state, or a level without a height, fits all. A join on ``by`` and
    the name, so rasters and records of one file meet and no others.
    """
    heights = F.coalesce(*[F.when(F.col("level") == level, height) for level, height in LEVEL_HEIGHTS.items()], F.lit(None).cast("int"))
    known = records.select(*by, F.lower("short").alias("__short"), "record", heights.alias("__height"), step_kind(F.col("step")).alias("__kind"))
    met = rasters.withColumn("__short", F.lower("short")).join(known, [*by, "__short"])
    fits = (F.col("step_kind").isNull() | (F.col("step_kind") == F.col("__kind"))) & (F.col("height").isNull() | F.col("__height").isNull() | (F.col("height") == F.col("__height")))
    return met.where(fits).select(*by, "raster", "record")
