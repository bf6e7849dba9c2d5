"""Calibration of quantiles and ladders. Fits are aggregates; appliers are joins with small tables or expressions."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.operators.ladder import LEVELS, TAGS, normalised
from isobar.operators.order_stats import quantiles, select_ranks
from isobar.operators.scoring import probability_bucket

MIN_SEGMENT_ROWS = 60
SHRINK_ROWS = 120.0


def offsets(df: DataFrame, y: str, by: Sequence[str] = (), columns: Sequence[str] = TAGS, levels: Sequence[float] = LEVELS) -> DataFrame:
    """Per level: the exact quantile, at that level, of y - prediction."""
    names = [f"offset_{c}" for c in columns]
    found = quantiles(df, by, {n: F.col(y) - F.col(c) for n, c in zip(names, columns, strict=True)}, {n: [level] for n, level in zip(names, levels, strict=True)}, [F.count("*").alias("n")])
    return found.select(*by, *[F.col(n)[0].alias(n) for n in names], "n")


def segmented_offsets(df: DataFrame, y: str, segment: str, columns: Sequence[str] = TAGS, levels: Sequence[float] = LEVELS, min_rows: int = MIN_SEGMENT_ROWS, shrink: bool = False) -> DataFrame:
    """Offsets of each segment: its own with ``min_rows`` rows, else the global ones.

    With ``shrink`` always global + min(1, n / 120) * (own - global).
    """
    everywhere = offsets(df, y, (), columns, levels).select(*[F.col(f"offset_{c}").alias(f"__{c}") for c in columns])
    own = offsets(df, y, (segment,), columns, levels).crossJoin(F.broadcast(everywhere))
    weight = F.least(F.lit(1.0), F.col("n") / SHRINK_ROWS)
    def value(c: str) -> Column:
        own_c, all_c = F.col(f"offset_{c}"), F.col(f"__{c}")
        return all_c + weight * (own_c - all_c) if shrink else F.when(F.col("n") >= min_rows, own_c).otherwise(all_c)

    return own.select(segment, "n", *[value(c).alias(f"offset_{c}") for c in columns])


def conformal(df: DataFrame, y: str, low: str, high: str, alpha: float, by: Sequence[str]) -> DataFrame:
    """Per group the margin that makes [low, high] cover 1 - alpha: the nonconformity of rank ceil((n + 1)(1 - alpha)), within 1..n.

    Equal scores are counted before they are ordered, and groups are ranked by
    stretches of scores, so no task needs a whole group.
    """
    score = F.greatest(F.col(low) - F.col(y), F.col(y) - F.col(high))
    scored = df.select(*by, score.alias("margin")).where("margin is not null")
    counted = scored.groupBy(*by, "margin").agg(F.count("*").alias("__c"))
    totals = counted.groupBy(*by).agg(F.sum("__c").alias("n"), F.min("margin").alias("__low"), F.max("margin").alias("__high"))
    placed = counted.join(totals, list(by)) if by else counted.crossJoin(F.broadcast(totals))
    stretch = F.when(F.col("__high") > F.col("__low"), F.floor((F.col("margin") - F.col("__low")) / (F.col("__high") - F.col("__low")) * 256)).otherwise(0).cast("int")
    placed = placed.withColumn("__stretch", stretch)
    sums = placed.groupBy(*by, "__stretch").agg(F.sum("__c").alias("__s"))
    before = Window.partitionBy(*by).orderBy("__stretch").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*by, "__stretch", F.coalesce(F.sum("__s").over(before), F.lit(0)).alias("__base"))
    own = Window.partitionBy(*by, "__stretch").orderBy("margin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = placed.join(base, [*by, "__stretch"]).withColumn("__upto", F.col("__base") + F.sum("__c").over(own))
    rank = F.least(F.greatest(F.ceil(F.round((F.col("n") + 1) * (1 - alpha), 9)), F.lit(1)), F.col("n"))
    return ranked.where((F.col("__upto") >= rank) & (F.col("__upto") - F.col("__c") < rank)).select(*by, "n", "margin")


def conformal_exact(df: DataFrame, y: str, low: str, high: str, alpha: float) -> DataFrame:
    """The same over all rows, by selection of the rank and not by gathering scores."""
    scored = df.select(F.greatest(F.col(low) - F.col(y), F.col(y) - F.col(high)).alias("score")).where("score is not null")
    n = scored.count()
    if not n:
        return scored.select(F.lit(0).cast("long").alias("n"), F.col("score").alias("margin")).limit(0)
    rank = min(max(math.ceil(round((n + 1) * (1 - alpha), 9)), 1), n)
    rows = scored.select(F.struct(F.lit(0).alias("all")).alias("g"), F.lit(0).alias("v"), F.col("score").cast("double").alias("x"))
    sizes = rows.groupBy("g", "v").agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    found = select_ranks(rows, sizes.select("g", "v", F.lit(rank - 1).cast("long").alias("rank")), sizes)
    return found.select(F.lit(n).cast("long").alias("n"), F.col("x").alias("margin"))


def bucket_factors(ladder: DataFrame, hit: Column, buckets: int = 10) -> DataFrame:
    """Per probability bucket: observed over predicted, within .05 and 20; 1 where nothing is predicted. Probabilities are added as decimals of 18 places, so that the sum does not hang on the order of the rows."""
    predicted = F.sum(F.col("probability").cast("decimal(28,18)")).cast("double")
    found = ladder.withColumn("bucket", probability_bucket(F.col("probability"), buckets)).groupBy("bucket").agg(predicted.alias("predicted"), F.sum(F.when(hit, 1.0).otherwise(0.0)).alias("observed"))
    return found.withColumn("factor", F.when(F.col("predicted") <= 1e-12, 1.0).otherwise(F.least(F.greatest(F.col("observed") / F.col("predicted"), F.lit(0.05)), F.lit(20.0))))


def recalibrated(ladder: DataFrame, factors: DataFrame, keys: Sequence[str], shrinkage: float, buckets: int = 10) -> DataFrame:
    """Each probability times 1 + shrinkage * (factor - 1) of its bucket, renormalised. ``factors`` has a row a bucket."""
    joined = ladder.withColumn("bucket", probability_bucket(F.col("probability"), buckets)).join(F.broadcast(factors.select("bucket", "factor")), "bucket", "left")
    out = joined.withColumn("probability", F.col("probability") * (1 + shrinkage * (F.coalesce("factor", F.lit(1.0)) - 1)))
    return normalised(out.drop("bucket", "factor"), keys)


Applier = Callable[[DataFrame], DataFrame]
#: Segments by name; more can be registered.
SEGMENTERS: dict[str, Callable[[], Column]] = {
    "season": lambda: F.when(F.month("day").between(4, 10), "warm").otherwise("cool"),
    "month": lambda: F.month("day").cast("string"),
    "all": lambda: F.lit("all"),
}
#: The pairs of quantiles and what each leaves outside.
INTERVALS = {("q05", "q95"): 0.10, ("q10", "q90"): 0.20, ("q25", "q75"): 0.50}
#: Regimes in which the sources agree.
CONSENSUS = ("tight_consensus", "moderate_disagreement")
UPPER_TAIL = ("q75", "q90", "q95")


def shifted(df: DataFrame, by: dict[str, Column], columns: Sequence[str] = TAGS) -> DataFrame:
    """Each quantile plus its shift, then rearranged to be monotone."""
    moved = df.withColumns({c: F.col(c) + by[c] for c in columns})
    return moved.withColumns({c: F.greatest(*[F.col(x) for x in columns[: k + 1]]) for k, c in enumerate(columns) if k})


def apply_offsets(df: DataFrame, fitted: DataFrame, factor: float = 1.0, zero: Sequence[str] = ()) -> DataFrame:
    """One row of offsets applied to all: times ``factor``, none for the levels in ``zero``."""
    by = {c: F.lit(0.0) if c in zero else factor * F.col(f"offset_{c}") for c in TAGS}
    return shifted(df.crossJoin(F.broadcast(fitted.select(*[f"offset_{c}" for c in TAGS]))), by).drop(*[f"offset_{c}" for c in TAGS])


def conformal_fit(df: DataFrame, y: str) -> DataFrame:
    """One row: the median's offset, and the margin of each interval."""
    out = offsets(df, y, (), ("q50",), (0.5,)).select("offset_q50")
    for (low, high), alpha in INTERVALS.items():
        margin = conformal(df, y, low, high, alpha, ()).agg(F.coalesce(F.max("margin"), F.lit(0.0)).alias(f"margin_{low}"))
        out = out.crossJoin(margin)
    return out


def apply_conformal(df: DataFrame, fitted: DataFrame) -> DataFrame:
    """Intervals widened by their margins, the median moved by its offset."""
    by = {"q50": F.col("offset_q50")}
    for low, high in INTERVALS:
        by |= {low: -F.col(f"margin_{low}"), high: F.col(f"margin_{low}")}
    return shifted(df.crossJoin(F.broadcast(fitted)), by).drop(*fitted.columns)


def conditional(df: DataFrame, regime: str, consensus: Applier, otherwise: Applier) -> DataFrame:
    """Rows of consensus regimes by one method, all others by another; a missing regime is no consensus."""
    agree = F.coalesce(F.col(regime).isin(*CONSENSUS), F.lit(False))
    return consensus(df.where(agree)).unionByName(otherwise(df.where(~agree)))


def methods(calibration: DataFrame, y: str, segments: Sequence[str] = ("season",), regime: str | None = None) -> dict[str, Applier]:
    """Calibrations fitted on ``calibration`` by name: none, global, half (shrunk), lower (no shift of the upper tail), conformal, one for each segmenter, and conditional with a column of regimes."""
    fitted = offsets(calibration, y)
    out: dict[str, Applier] = {
        "none": lambda df: df,
        "global": lambda df: apply_offsets(df, fitted),
        "half": lambda df: apply_offsets(df, fitted, factor=0.5),
        "lower": lambda df: apply_offsets(df, fitted, zero=UPPER_TAIL),
        "conformal": lambda df, fit=conformal_fit(calibration, y): apply_conformal(df, fit),
    }
    for name in segments:
        segment = SEGMENTERS[name]
        own = segmented_offsets(calibration.withColumn("__segment", segment()), y, "__segment").drop("n")
        everywhere = fitted.select(*[F.col(f"offset_{c}").alias(f"__{c}") for c in TAGS])

        def by_segment(df: DataFrame, segment: Callable[[], Column] = segment, own: DataFrame = own, everywhere: DataFrame = everywhere) -> DataFrame:
            joined = df.withColumn("__segment", segment()).join(F.broadcast(own), "__segment", "left").crossJoin(F.broadcast(everywhere))
            return shifted(joined, {c: F.coalesce(F.col(f"offset_{c}"), F.col(f"__{c}")) for c in TAGS}).drop("__segment", *[f"offset_{c}" for c in TAGS], *[f"__{c}" for c in TAGS])

        out[name] = by_segment
    if regime is not None:
        out["conditional"] = lambda df: conditional(df, regime, out["half"], out["global"])
    return out


def shrinkage_grid(ladder: DataFrame, factors: DataFrame, keys: Sequence[str], hit: Column, grid: Sequence[float], buckets: int = 10, epsilon: float = 1e-12) -> DataFrame:
    """Mean negative log likelihood of the recalibrated ladder for each shrinkage of the grid, in one pass over the ladder: shrinkage, n, nll."""
    bucket = probability_bucket(F.col("probability"), buckets)
    joined = ladder.withColumns({"bucket": bucket, "__hit": hit}).join(F.broadcast(factors.select("bucket", "factor")), "bucket", "left")
    mass = [F.col("probability") * (1 + s * (F.coalesce("factor", F.lit(1.0)) - 1)) for s in grid]
    sums = joined.groupBy(*keys).agg(*[F.sum(m).alias(f"t{k}") for k, m in enumerate(mass)], *[F.coalesce(F.sum(F.when(F.col("__hit"), m)), F.lit(0.0)).alias(f"p{k}") for k, m in enumerate(mass)])
    scores = [F.avg(-F.log(F.greatest(F.col(f"p{k}") / F.col(f"t{k}"), F.lit(epsilon)))).alias(f"s{k}") for k in range(len(grid))]
    found = sums.agg(F.count("*").alias("n"), *scores)
    return found.select("n", F.explode(F.array(*[F.struct(F.lit(float(s)).alias("shrinkage"), F.col(f"s{k}").alias("nll")) for k, s in enumerate(grid)])).alias("r")).select("r.shrinkage", "n", "r.nll")
