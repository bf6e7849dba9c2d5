"""Scores of ladders, quantiles and point forecasts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.operators.ladder import cumulative
from isobar.operators.order_stats import kept, quantiles

EPSILON = 1e-12


def ladder_scores(ladder: DataFrame, keys: Sequence[str], observed: str) -> DataFrame:
    """Per key: nll, brier, rps, pit_low, pit_mid, pit_high, observed_probability, modal_f and modal_hit.

    ``observed`` is the column of the observed whole degree, the same in all of
    a key's rows. One shuffle on the key, one aggregate.
    """
    d, p, o = F.col("temp_f"), F.col("probability"), F.col(observed)
    hit = d == o
    rows = cumulative(ladder, keys)
    found = rows.groupBy(*keys).agg(
        F.coalesce(F.max(F.when(hit, p)), F.lit(0.0)).alias("observed_probability"),
        F.sum((p - F.when(hit, 1.0).otherwise(0.0)) * (p - F.when(hit, 1.0).otherwise(0.0))).alias("brier"),
        F.avg((F.col("cdf") - F.when(d >= o, 1.0).otherwise(0.0)) * (F.col("cdf") - F.when(d >= o, 1.0).otherwise(0.0))).alias("rps"),
        F.coalesce(F.sum(F.when(d < o, p)), F.lit(0.0)).alias("pit_low"),
        F.max_by(d, F.struct(p, -d)).alias("modal_f"),
        F.max(p).alias("modal_probability"),
        F.first(o).alias("observed_f"),
    )
    return found.withColumns({
        "nll": -F.log(F.greatest(F.col("observed_probability"), F.lit(EPSILON))),
        "pit_mid": F.col("pit_low") + 0.5 * F.col("observed_probability"),
        "pit_high": F.col("pit_low") + F.col("observed_probability"),
        "modal_hit": F.col("modal_f") == F.col("observed_f"),
    })


def bin_scores(masses: DataFrame, keys: Sequence[str], hit: Column) -> DataFrame:
    """Per key: nll and brier of bins (name, probability); ``hit`` marks the bin that came."""
    p, o = F.col("probability"), F.when(hit, 1.0).otherwise(0.0)
    found = masses.groupBy(*keys).agg(F.sum(p * o).alias("observed_probability"), F.sum((p - o) * (p - o)).alias("brier"))
    return found.withColumn("nll", -F.log(F.greatest(F.col("observed_probability"), F.lit(EPSILON))))


def pinball(y: Column, q: Column, level: float) -> Column:
    return F.avg(F.greatest(level * (y - q), (level - 1) * (y - q)))


def interval_score(y: Column, low: Column, high: Column, alpha: float) -> Column:
    """Width plus 2/alpha for each degree outside."""
    return F.avg(high - low + (2 / alpha) * (F.greatest(low - y, F.lit(0.0)) + F.greatest(y - high, F.lit(0.0))))


def error_summary(df: DataFrame, by: Sequence[str], y: Column, x: Column) -> DataFrame:
    """Per group: n, mae, rmse, bias, exact median and third quartile of the absolute error, and the shares within 1 and 2.

    Errors are written once: what is under ``df`` (joins, most often) is not run again by every pass of the quantiles.
    """
    e = F.col("__e")
    found = quantiles(kept(df.select(*by, (x - y).alias("__e"))), by, {"__q": F.abs(e)}, {"__q": (0.5, 0.75)}, [
        F.count("*").alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), F.avg(e).alias("bias"),
        F.avg((F.abs(e) <= 1).cast("double")).alias("within_1"), F.avg((F.abs(e) <= 2).cast("double")).alias("within_2"),
    ])
    return found.select(*by, "n", "mae", "rmse", "bias", F.col("__q")[0].alias("median_abs_error"), F.col("__q")[1].alias("p75_abs_error"), "within_1", "within_2")


def probability_bucket(p: Column, buckets: int = 10) -> Column:
    """1..buckets; an edge belongs to the bucket below it, and 0 to the first. Rounding noise does not cross an edge."""
    return F.least(F.greatest(F.ceil(F.round(p * buckets, 9)), F.lit(1)), F.lit(buckets)).cast("long")


def reliability(df: DataFrame, p: str, hit: Column, buckets: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """Per bucket: n, mean probability, observed share and their gap."""
    found = df.withColumn("bucket", probability_bucket(F.col(p), buckets)).groupBy(*by, "bucket").agg(F.count("*").alias("n"), F.avg(p).alias("mean_probability"), F.avg(F.when(hit, 1.0).otherwise(0.0)).alias("observed_share"))
    return found.withColumn("gap", F.col("observed_share") - F.col("mean_probability"))


def sliced(df: DataFrame, slices: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """The aggregates over all rows and by each slice column, in one pass: slice, value and the aggregates."""
    exploded = df.withColumn("__s", F.explode(F.array(F.struct(F.lit("all").alias("slice"), F.lit("all").alias("value")), *[F.struct(F.lit(s).alias("slice"), F.col(s).cast("string").alias("value")) for s in slices])))
    return exploded.groupBy(F.col("__s.slice").alias("slice"), F.col("__s.value").alias("value")).agg(*aggregates)


def fold_summary(df: DataFrame, by: Sequence[str], metric: str, rows: str) -> DataFrame:
    """Across folds: row-weighted mean, mean, population deviation, and the rank by the weighted mean."""
    found = df.groupBy(*by).agg(
        (F.sum(F.col(metric) * F.col(rows)) / F.sum(rows)).alias("weighted_mean"), F.avg(metric).alias("mean"), F.stddev_pop(metric).alias("std"), F.count("*").alias("folds")
    )
    return found.withColumn("rank", F.rank().over(Window.orderBy("weighted_mean")))


def pit_slices(df: DataFrame, pit: str, slices: dict[str, Column]) -> DataFrame:
    """Per slice (overall, and each of ``slices`` where its condition holds): rows, mean, population deviation and the shares below 0.1 and above 0.9, in one pass; slices overlap."""
    names = F.array_compact(F.array(F.lit("overall"), *[F.when(c, F.lit(n)) for n, c in slices.items()]))
    p = F.col(pit)
    return df.where(p.isNotNull()).withColumn("slice", F.explode(names)).groupBy("slice").agg(
        F.count("*").alias("row_count"), F.avg(p).alias("pit_mean"), F.stddev_pop(p).alias("pit_std"), F.avg(F.when(p < 0.1, 1.0).otherwise(0.0)).alias("pit_below_0_1"), F.avg(F.when(p > 0.9, 1.0).otherwise(0.0)).alias("pit_above_0_9"),
    )
