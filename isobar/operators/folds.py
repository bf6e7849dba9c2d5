"""Splits in time, ensembles and parity checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chronological_split(df: DataFrame, day: str, share: float) -> DataFrame:
    """part: train up to the day that closes ``share`` of all days, validation after it; a day is never split."""
    days = df.select(day).distinct()
    cut = days.agg(F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY datediff({day}, DATE'1970-01-01'))").alias("cut"))
    return df.crossJoin(F.broadcast(cut)).withColumn("part", F.when(F.datediff(day, F.lit("1970-01-01").cast("date")) <= F.col("cut"), "train").otherwise("validation")).drop("cut")


def rolling_origin(df: DataFrame, day: str, origins: Sequence[tuple[str, str, str]]) -> DataFrame:
    """A row for each fold (train end, first and last day of validation) that holds the row: fold, part.

    Training is everything up to the fold's end; a fold whose validation does
    not begin after its training is refused.
    """
    for end, first, last in origins:
        if not end < first <= last:
            raise ValueError(f"fold {end}, {first}, {last} leaks")
    d = F.col(day).cast("string")
    parts = F.array(*[F.struct(F.lit(k).cast("long").alias("fold"), F.when(d <= end, "train").when(d.between(first, last), "validation").alias("part")) for k, (end, first, last) in enumerate(origins)])
    return df.withColumn("__f", F.explode(F.filter(parts, lambda p: p["part"].isNotNull()))).select("*", "__f.fold", "__f.part").drop("__f")


def ensemble_mean(df: DataFrame, keys: Sequence[str], member: str, columns: Sequence[str], members: Sequence[str]) -> DataFrame:
    """Mean of the members' columns per key; keys without exactly these members are left out."""
    found = df.where(F.col(member).isin(*members)).groupBy(*keys).agg(F.countDistinct(member).alias("__n"), F.count("*").alias("__rows"), *[F.avg(c).alias(c) for c in columns])
    return found.where((F.col("__n") == len(members)) & (F.col("__rows") == len(members))).drop("__n", "__rows")


def parity(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Per column: rows on both sides, rows on one side only, null on one side only, and the largest difference."""
    a = left.select(*keys, *[F.col(c).cast("double").alias(f"__a_{c}") for c in columns], F.lit(1).alias("__in_a"))
    b = right.select(*keys, *[F.col(c).cast("double").alias(f"__b_{c}") for c in columns], F.lit(1).alias("__in_b"))
    both = a.join(b, list(keys), "full")
    here = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull()

    def stats(c: str) -> Column:
        x, y = F.col(f"__a_{c}"), F.col(f"__b_{c}")
        return F.struct(F.lit(c).alias("column"), F.count_if(here).alias("rows"), F.count_if(~here).alias("unmatched"), F.count_if(here & (x.isNull() != y.isNull())).alias("null_differs"), F.max(F.when(here, F.abs(x - y))).alias("max_difference"))

    return both.agg(F.array(*[stats(c) for c in columns]).alias("r")).select(F.inline("r"))


def payload(keys: Sequence[str], values: Sequence[str], digits: int = 4) -> Column:
    """A prediction row as JSON: keys as they are, values rounded."""
    return F.to_json(F.struct(*keys, F.struct(*[F.round(v, digits).alias(v) for v in values]).alias("quantiles")))
