"""Joins of intervals that overlap, by dyadic buckets.

An interval's level is the least power of two that is not shorter than it, so
it touches two buckets of that width at most. Two intervals meet at the higher
of their levels: one with its own buckets, the other, if it is shorter, as a
guest of that level. Guests never meet guests, and of the two buckets that a
pair can share only that with the later start is its owner, so a pair is met
once and nothing has to be made distinct. The join is one on equality of key,
level and bucket, which the engine can split where a key is hot; no interval is
cut into units of time.

Intervals are closed, in whole units (days, or microseconds for instants).
Null keys, null ends and ends before their starts match nothing. Repeated rows
are rows of their own. Empty tables give no pairs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _numbered(c: Column, kind: str) -> Column:
    if kind == "date":
        return F.unix_date(c).cast("long")
    return F.unix_micros(c.cast("timestamp")) if kind.startswith("timestamp") else c.cast("long")


def _sided(df: DataFrame, on: Sequence[str], ends: tuple[str, str], side: str) -> DataFrame:
    """The rows as a struct, their keys, and start, end and level in whole units."""
    kinds = dict(df.dtypes)
    start, end = (_numbered(F.col(c), kinds[c]) for c in ends)
    rows = df.select(F.struct("*").alias(side), *[F.col(c).alias(f"__k{k}") for k, c in enumerate(on)], start.alias("__s"), end.alias("__e")).where("__s <= __e")
    return rows.withColumn("__own", F.ceil(F.log2((F.col("__e") - F.col("__s") + 1).cast("double"))).cast("int"))


def _buckets(level: Column) -> Column:
    """All (level, bucket) of a level that an interval touches."""
    return F.transform(F.sequence(F.call_function("shiftright", F.col("__s"), level), F.call_function("shiftright", F.col("__e"), level)), lambda b: F.struct(level.alias("level"), b.alias("bucket")))


def overlaps(left: DataFrame, right: DataFrame, on: Sequence[str], left_ends: tuple[str, str], right_ends: tuple[str, str]) -> DataFrame:
    """left and right (structs of their rows) of every pair with equal keys that overlaps, and covered, the units that both hold."""
    a, b = _sided(left, on, left_ends, "left"), _sided(right, on, right_ends, "right")
    levels = {side: sorted(r[0] for r in df.select("__own").distinct().collect()) for side, df in (("a", a), ("b", b))}

    def own(df: DataFrame) -> DataFrame:
        return df.withColumn("__m", F.explode(_buckets(F.col("__own"))))

    def guest(df: DataFrame, above: list[int]) -> DataFrame:
        higher = F.filter(F.array(*map(F.lit, above)).cast("array<int>"), lambda x: x > F.col("__own"))
        return df.withColumn("__m", F.explode(F.flatten(F.transform(higher, _buckets))))

    keys = [*[f"__k{k}" for k in range(len(on))], "__level", "__bucket"]

    def met(x: DataFrame, y: DataFrame) -> DataFrame:
        x, y = (df.select(df.columns[0], *keys[:-2], F.col("__m.level").alias("__level"), F.col("__m.bucket").alias("__bucket"), F.col("__s").alias(f"__s{n}"), F.col("__e").alias(f"__e{n}")) for n, df in enumerate((x, y)))
        later, sooner = F.greatest("__s0", "__s1"), F.least("__e0", "__e1")
        pairs = x.join(y, keys).where((later <= sooner) & (F.call_function("shiftright", later, F.col("__level")) == F.col("__bucket")))
        return pairs.select("left", "right", (sooner - later + 1).alias("covered"))

    return met(own(a), own(b)).unionByName(met(own(a), guest(b, levels["a"]))).unionByName(met(guest(a, levels["b"]), own(b)))
