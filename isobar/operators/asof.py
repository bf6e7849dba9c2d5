"""As-of joins, trailing windows and issue choice.

None of them pairs rows by inequality: both sides are united, sorted once by
(key, time), and the last right-hand row before each left-hand one is carried
forward. Keys are counted first: one of at most ``HOT_ROWS`` rows is sorted
whole. A hotter one is cut into stretches at quantiles of its own times, so
stretches have about as many rows wherever the key is dense, and only the last
row of each is carried along the key: a key may have any number of rows.
``bucket_hours`` gives stretches of one length to all keys instead; None sorts
whole keys.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.functions.timeops import micros

HOUR = 3_600_000_000
#: Rows of a key that one task sorts, and the most stretches that a hotter key is cut into.
HOT_ROWS, MOST_STRETCHES = 1_000_000, 512
#: Stretches by counted keys.
COUNTED = "counted"
#: The length of a stretch of trailing windows, where keys are hot.
BUCKET_HOURS = 168.0


def hot_keys(df: DataFrame, by: Sequence[str]) -> int:
    """The rows of the largest key, if one task must not sort it; else 0."""
    most = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    return most if most > HOT_ROWS else 0


def in_stretches(df: DataFrame, by: Sequence[str], t: str, bucket_hours: float | str | None) -> DataFrame | None:
    """``df`` with ``__bucket``, the stretch of a row by its microseconds ``t``; None where whole keys are sorted.

    The quantiles are those of a sketch of bounded size a hot key; they choose
    where stretches begin and nothing else.
    """
    if bucket_hours is None:
        return None
    if bucket_hours != COUNTED:
        return df.withColumn("__bucket", F.floor(F.col(t) / int(bucket_hours * HOUR)))
    most = hot_keys(df, by)
    if not most:
        return None
    cuts = min(MOST_STRETCHES, math.ceil(2 * most / max(HOT_ROWS, 1)))
    same = [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(by)]
    hot = df.groupBy(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(by)]).agg(F.count("*").alias("__n")).where(F.col("__n") > HOT_ROWS).drop("__n")
    there = df.join(hot, reduce(lambda x, y: x & y, same), "left_semi")
    bounds = there.groupBy(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(by)]).agg(F.percentile_approx(t, [k / cuts for k in range(1, cuts)] or [0.5], 2_000).alias("__bounds"))
    found = df.join(bounds, reduce(lambda x, y: x & y, same), "left")
    before = F.aggregate("__bounds", F.lit(0), lambda n, b: n + (b <= F.col(t)).cast("int"))
    return found.withColumn("__bucket", F.coalesce(before, F.lit(0))).drop("__bounds", *[f"__h{i}" for i in range(len(by))])


def asof_backward(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, values: Sequence[str], prefix: str = "", tie: Sequence[str] = (), back_hours: float = 0.0, max_age_hours: float | None = None, bucket_hours: float | str | None = COUNTED) -> DataFrame:
    """Each row of ``left`` with ``values`` of the last row of ``right`` at or before ``left_time`` - ``back_hours``.

    Of rows with one time the last by ``tie`` counts. The matched row's values
    stay even where they are null. No match, or one that is ``max_age_hours``
    old or more, gives nulls.
    """
    shift = int(back_hours * HOUR)
    names = [f"{prefix}{v}" for v in values]
    keys = [f"__k{i}" for i in range(len(on))]
    match = F.struct(F.col(right_time).alias("__at"), *[F.col(v).alias(n) for v, n in zip(values, names, strict=True)])
    own = [F.col(k).alias(name) for k, name in zip(on, keys, strict=True)]
    rights = right.select(*own, (micros(F.col(right_time)) + shift).alias("__t"), F.lit(0).alias("__side"), F.struct(*[F.col(c) for c in tie] or [F.lit(0)]).alias("__tie"), match.alias("__match"), F.lit(None).cast(left.select(F.struct("*").alias("s")).schema["s"].dataType).alias("__row"))
    lefts = left.select(*own, micros(F.col(left_time)).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(rights.schema["__tie"].dataType).alias("__tie"), F.lit(None).cast(rights.schema["__match"].dataType).alias("__match"), F.struct("*").alias("__row"))
    both = rights.unionByName(lefts)
    dealt = in_stretches(both, keys, "__t", bucket_hours)
    both, by = (both, keys) if dealt is None else (dealt, [*keys, "__bucket"])
    order = Window.partitionBy(*by).orderBy("__t", "__side", "__tie").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("__last", F.last("__match", ignorenulls=True).over(order)).where("__side = 1")
    if dealt is not None:
        ends = both.groupBy(*by).agg(F.max_by("__match", F.when(F.col("__side") == 0, F.struct("__t", "__tie"))).alias("__end"))
        earlier = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
        carried = ends.select(*by, F.last("__end", ignorenulls=True).over(earlier).alias("__carried")).withColumnsRenamed({k: f"__c{k}" for k in by})
        same = [F.col(k).eqNullSafe(F.col(f"__c{k}")) for k in by]
        found = found.join(carried, reduce(lambda x, y: x & y, same), "left").withColumn("__last", F.coalesce("__last", "__carried"))
    last = F.col("__last")
    if max_age_hours is not None:
        last = F.when(micros(F.col("__last.__at")) > F.col("__t") - shift - int(max_age_hours * HOUR), last)
    found = found.withColumn("__last", last)
    return found.select("__row.*", F.col("__last.__at").alias(f"{prefix}matched_at"), *[F.col(f"__last.{n}").alias(n) for n in names])


def trailing(columns: dict[str, Column], time: str, by: Sequence[str], hours: float) -> dict[str, Column]:
    """Aggregates over the half-open window (t - hours, t] of each row's key, t included."""
    window = Window.partitionBy(*by).orderBy(micros(F.col(time))).rangeBetween(-int(hours * HOUR) + 1, 0)
    return {name: column.over(window) for name, column in columns.items()}


def with_trailing(df: DataFrame, columns: dict[str, Column], time: str, by: Sequence[str], hours: float, bucket_hours: float | str | None = COUNTED) -> DataFrame:
    """``df`` with :func:`trailing` aggregates.

    Where a key is hot, or ``bucket_hours`` is given, keys are cut into
    stretches of that length, or of ``hours`` if these are more, and a row that
    the next stretch's windows still reach lends itself to it, so no task needs
    a whole key.
    """
    if bucket_hours == COUNTED:
        bucket_hours = BUCKET_HOURS if hot_keys(df, by) else None
    if bucket_hours is None:
        return df.select("*", *[c.alias(n) for n, c in trailing(columns, time, by, hours).items()])
    width = int(max(bucket_hours, hours) * HOUR)
    own, at = F.floor(micros(F.col(time)) / width), F.pmod(micros(F.col(time)), F.lit(width))
    buckets = F.when(at >= width - int(hours * HOUR), F.array("__own", F.col("__own") + 1)).otherwise(F.array("__own"))
    lent = df.withColumn("__own", own).withColumn("__bucket", F.explode(buckets))
    found = lent.select("*", *[c.alias(n) for n, c in trailing(columns, time, [*by, "__bucket"], hours).items()])
    return found.where("__bucket = __own").drop("__own", "__bucket")


def values_before(df: DataFrame, keep: Sequence[str], value: str, time: str, by: Sequence[str], hours: Sequence[float], tie: Sequence[str] = (), bucket_hours: float | str | None = COUNTED) -> DataFrame:
    """``keep``, which identify a row, and before_{h}h: the value of the key's last row at or before its time less h hours, null where that is null. One pass for all ``hours``."""
    asks = df.select(*keep, *[c for c in (*by, time) if c not in keep], F.explode(F.array(*map(F.lit, hours))).alias("__h"))
    asks = asks.withColumn("__asked", F.col(time).cast("timestamp_ntz") - F.make_dt_interval(secs=F.col("__h") * 3600))
    found = asof_backward(asks, df, by, "__asked", time, [value], "before_", tie, bucket_hours=bucket_hours)
    return found.groupBy(*keep).agg(*[F.max(F.when(F.col("__h") == h, F.col(f"before_{value}"))).alias(f"before_{h}h") for h in hours])


def with_previous(df: DataFrame, by: Sequence[str], time: str, tie: Sequence[str], values: Sequence[str], prefix: str, bucket_hours: float | str | None = COUNTED) -> DataFrame:
    """Each row with ``values`` of the row before it of its key, in the order of time and ``tie``."""
    own = F.struct(*[F.col(v).alias(f"{prefix}{v}") for v in values])
    rows = in_stretches(df.withColumn("__t", micros(F.col(time))), by, "__t", bucket_hours)
    if rows is None:
        return df.withColumn("__p", F.lag(own).over(Window.partitionBy(*by).orderBy(time, *tie))).select(*df.columns, "__p.*")
    ends = rows.groupBy(*by, "__bucket").agg(F.max_by(own, F.struct(time, *tie)).alias("__end"))
    order = Window.partitionBy(*by, "__bucket").orderBy(time, *tie)
    rows = rows.withColumns({"__p": F.lag(own).over(order), "__first": F.row_number().over(order) == 1})
    keys = [*by, "__bucket"]
    carried = ends.select(*keys, F.lag("__end").over(Window.partitionBy(*by).orderBy("__bucket")).alias("__carried")).withColumnsRenamed({k: f"__c{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"__c{k}")) for k in keys]
    return rows.join(carried, reduce(lambda x, y: x & y, same), "left").withColumn("__p", F.when(F.col("__first"), F.col("__carried")).otherwise(F.col("__p"))).select(*df.columns, "__p.*")


def value_before(value: str, time: str, by: Sequence[str], hours: float, tie: str | None = None) -> Column:
    """The value of the last row of the key at or before t - hours, null where that is null.

    With several rows at that time, the one with the largest ``tie``.
    """
    window = Window.partitionBy(*by).orderBy(micros(F.col(time))).rangeBetween(Window.unboundedPreceding, -int(hours * HOUR))
    # max_by keeps the matched row's null, and its order is total where last() would have to trust the sort.
    return F.max_by(F.col(value), F.struct(micros(F.col(time)), F.col(tie or time))).over(window)


def cutoff_snapshot(observations: DataFrame, spine: DataFrame, by: Sequence[str], time: str, cutoff: str, value: str, changes: Sequence[int] = (1, 3, 6), tie: Sequence[str] = (), bucket_hours: float | str | None = COUNTED) -> DataFrame:
    """Last value at or before each ``cutoff`` of the spine, and its change since ``changes`` hours before the cutoff.

    All moments are looked up in one pass: a row of the spine asks once for
    each, and the answers meet again on the spine's own columns, which must be
    unique together.
    """
    hours = F.explode(F.array(F.lit(0), *map(F.lit, changes)))
    asked = spine.withColumn("__h", hours).withColumn("__asked", F.col(cutoff) - F.make_dt_interval(hours=F.col("__h")))
    found = asof_backward(asked, observations, by, "__asked", time, [value], "last_", tie, bucket_hours=bucket_hours)

    def at(h: int, column: str) -> Column:
        return F.max(F.when(F.col("__h") == h, F.col(column)))

    last = f"last_{value}"
    return found.groupBy(*spine.columns).agg(at(0, "last_matched_at").alias("last_matched_at"), at(0, last).alias(last), *[(at(0, last) - at(h, last)).alias(f"change_{h}h") for h in changes])


def window_before(observations: DataFrame, spine: DataFrame, by: Sequence[str], time: str, cutoff: str, hours: int, aggregates: dict[str, Column], day: str, observation_day: Column, days_back: int | None = None) -> DataFrame:
    """Aggregates over (cutoff - hours, cutoff] for each row of the spine; an empty window gives nulls.

    The inequality is bucketed by day first: an observation meets the cutoffs of
    its own local day and of the ``days_back`` after it only. By default these
    are as many as the window can reach back, with an hour for clock changes.
    """
    days_back = math.ceil((hours + 1) / 24) if days_back is None else days_back
    if days_back * 24 < hours:
        raise ValueError("the window reaches further back than the days that an observation is dealt to")
    dealt = observations.withColumn(day, F.explode(F.sequence(observation_day, F.date_add(observation_day, days_back))))
    joined = spine.select(*by, day, cutoff).join(dealt, [*by, day])
    t, c = micros(F.col(time)), micros(F.col(cutoff))
    inside = joined.where((t <= c) & (t > c - hours * HOUR))
    found = inside.groupBy(*by, day).agg(*[a.alias(n) for n, a in aggregates.items()])
    return spine.join(found, [*by, day], "left")


def nearby_window(observations: DataFrame, spine: DataFrame, by: Sequence[str], time: str, cutoff: str, value: str, wind: str, hours: int, day: str, observation_day: Column, tie: Sequence[str] = (), max_age_hours: float = 12.0) -> DataFrame:
    """A nearby station's change over ``hours`` and mean wind of (cutoff - hours, cutoff]: both only where a row at or before the window's begin exists to compare with.

    The last row must not be ``max_age_hours`` old.
    """
    last = asof_backward(spine, observations, by, cutoff, time, [value], "last_", tie, max_age_hours=max_age_hours)
    both = asof_backward(last, observations, by, cutoff, time, [value], "before_", tie, back_hours=hours)
    there = F.col("last_matched_at").isNotNull() & F.col("before_matched_at").isNotNull()
    mean = window_before(observations, spine, by, time, cutoff, hours, {"__mean": F.avg(wind)}, day, observation_day).select(*by, day, "__mean")
    return both.join(mean, [*by, day], "left").select(*spine.columns, F.when(there, F.col(f"last_{value}") - F.col(f"before_{value}")).alias(f"{value}_change_{hours}h"), F.when(there, F.col("__mean")).alias(f"{wind}_mean_{hours}h"))


def planned_cycles(cycles: DataFrame, days: DataFrame, by: Sequence[str], init: str, day: str, start: Column, cutoff: Column, keep: Sequence[str]) -> DataFrame:
    """For each day the last cycle whose ``init`` lies in [start, cutoff], both included; one cycle may serve many days."""
    spine = days.select(*by, day, start.alias("__start"), cutoff.alias("__cutoff"))
    found = asof_backward(spine, cycles, by, "__cutoff", init, [init, *keep], "", [init])
    return found.where(micros(F.col(init)) >= micros(F.col("__start"))).select(*by, day, init, *keep)


def issue_for_day(issues: DataFrame, spine: DataFrame, by: Sequence[str], valid_day: str, available: str, init: str, cutoff: str, keep: Sequence[str]) -> DataFrame:
    """Of the issues that carry a row's own valid day, the last available at or before its cutoff, of equals that of the last init; none gives nulls."""
    inside = issues.join(spine.select(*by, valid_day, cutoff), [*by, valid_day]).where(micros(F.col(available)) <= micros(F.col(cutoff)))
    last = inside.groupBy(*by, valid_day).agg(F.max(F.struct(available, init, *keep)).alias("__last"))
    return spine.join(last, [*by, valid_day], "left").select(*spine.columns, "__last.*")


def latest_issues(issues: DataFrame, spine: DataFrame, by: Sequence[str], available: str, cutoff: str, keep: Sequence[str], tie: Sequence[str] = (), bucket_hours: float | str | None = COUNTED) -> DataFrame:
    """For each row of the spine the last issue available at or before its cutoff, and the issue before that one.

    Columns latest_* and previous_* of ``keep``; null where there is none.
    """
    chained = with_previous(issues.select(*dict.fromkeys([*by, available, *tie, *keep])), by, available, tie, keep, "__previous_", bucket_hours)
    found = asof_backward(spine, chained, by, cutoff, available, [*keep, *[f"__previous_{c}" for c in keep]], "latest_", tie, bucket_hours=bucket_hours)
    return found.withColumnsRenamed({f"latest___previous_{c}": f"previous_{c}" for c in keep})
