"""Exact quantiles of many groups without a group's values in one buffer.

Groups of at most ``BUFFER_ROWS`` rows are one aggregate each, in a buffer of
that size. Beyond it, ranks are found by selection through histograms, for all
groups, values and levels at once: the range that holds a rank is cut into
``BINS`` bins, rows are counted by bin before the shuffle, and only the bin
that holds the rank goes on, with its own least and largest value as the next
range. A rank is found when its bin holds one value only. What a task sees of a
group is ``BINS`` counts, whatever the group's rows.

Nulls and NaN count as missing; a group without values has null quantiles;
infinite values are values. Ties are counted, not listed. Null keys are a
group. An empty table gives no groups (one row of nulls without ``by``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.session import scratch_path

BUFFER_ROWS = 100_000
BINS = 1_024
#: Ranges are cut this often at most; values that still share one (there are some thousand doubles between them) are counted one by one.
PASSES = 16


def _value(x: Column) -> Column:
    x = x.cast("double")
    return F.when(~F.isnan(x), x)


def _halves(x: Column) -> tuple[Column, Column]:
    """The upper 26 bits of a double and the rest: products of such halves are exact."""
    wide = x * 134217729.0
    upper = wide - (wide - x)
    return upper, x - upper


def between_ranks(low: Column, high: Column, share: Column) -> Column:
    """low * (1 - share) + high * share, the first product and the sum rounded once (a fused multiply-add): to the last bit what DuckDB's quantile_cont gives. Two equal values go the same way and may come out a bit beside themselves, as there."""
    rest = 1 - share
    product, other = low * rest, high * share
    (a, b), (c, d) = _halves(low), _halves(rest)
    lost = ((a * c - product) + a * d + b * c) + b * d
    total = product + other
    back = total - product
    lost = lost + ((product - (total - back)) + (other - back))
    fused = F.when(F.isnan(lost), total).otherwise(total + lost)
    return F.when(share == 0, low).otherwise(fused)


def _at_levels(sorted_values: Column, levels: Sequence[float]) -> Column:
    def ranks(level: float) -> Column:
        place = F.lit(float(level)) * (F.size(sorted_values) - 1)
        low, high = (F.get(sorted_values, side(place).cast("int")) for side in (F.floor, F.ceil))
        return F.struct(low.alias("low"), high.alias("high"), (place - F.floor(place)).alias("share"))

    found = F.transform(F.array(*map(ranks, levels)), lambda r: between_ranks(r["low"], r["high"], r["share"]))
    return F.when(F.size(sorted_values) > 0, found)


def quantiles(df: DataFrame, by: Sequence[str], values: Mapping[str, Column], levels: Mapping[str, Sequence[float]], extra: Sequence[Column] = (), buffer_rows: int = BUFFER_ROWS) -> DataFrame:
    """A row a group: ``by``, for each of ``values`` an array of its exact quantiles at ``levels`` (between two ranks by proportion), and the aggregates ``extra``."""
    most = df.groupBy(*by).agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    if most <= buffer_rows:
        sorted_values = [F.sort_array(F.collect_list(_value(x))).alias(name) for name, x in values.items()]
        found = df.groupBy(*by).agg(*sorted_values, *extra)
        return found.withColumns({name: _at_levels(F.col(name), levels[name]) for name in values})
    names = list(values)
    group = F.struct(*[F.col(c) for c in by]) if by else F.struct(F.lit(0).alias("all"))
    each = F.explode(F.array(*[F.struct(F.lit(k).alias("v"), _value(values[name]).alias("x")) for k, name in enumerate(names)]))
    rows = df.select(group.alias("g"), each.alias("e")).select("g", "e.*").where("x is not null")
    rows = kept(rows)
    asked = F.lit(None).cast("array<double>")
    for k, name in enumerate(names):
        asked = F.when(F.col("v") == k, F.array(*map(F.lit, map(float, levels[name])))).otherwise(asked)
    sizes = kept(rows.groupBy("g", "v").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi")))
    place = sizes.select("g", "v", "n", F.posexplode(asked).alias("k", "level")).withColumn("p", F.col("level") * (F.col("n") - 1))
    place = place.select("g", "v", "k", "p", F.floor("p").alias("low"), F.ceil("p").alias("high"))
    ranks = place.select("g", "v", F.explode(F.array("low", "high")).alias("rank")).distinct()
    found = select_ranks(rows, ranks, sizes)
    low, high = (found.select("g", "v", F.col("rank").alias(side), F.col("x").alias(f"x_{side}")) for side in ("low", "high"))
    ranked = place.join(low, ["g", "v", "low"]).join(high, ["g", "v", "high"])
    value = between_ranks(F.col("x_low"), F.col("x_high"), F.col("p") - F.col("low"))
    listed = F.array_sort(F.collect_list(F.struct("k", value.alias("x"))))
    of_each = ranked.groupBy("g", "v").agg(F.transform(listed, lambda s: s["x"]).alias("q"))
    wide = of_each.groupBy("g").agg(*[F.max(F.when(F.col("v") == k, F.col("q"))).alias(name) for k, name in enumerate(names)])
    if not by:
        return df.agg(F.count("*").alias("__n"), *extra).crossJoin(F.broadcast(wide.drop("g"))).drop("__n")
    rest = df.groupBy(*by).agg(F.count("*").alias("__n"), *extra).withColumn("__g", F.struct(*by))
    own = [c for c in rest.columns if c not in (*by, "__g", "__n")]
    return rest.join(wide.withColumnRenamed("g", "__g"), "__g", "left").select(*by, *names, *own)


def kept(df: DataFrame) -> DataFrame:
    """``df`` as a table of the session's scratch folder, so that the next pass starts from rows and not from all passes before."""
    path = scratch_path(df.sparkSession, "ranks")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bin(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """0..bins-1, never falling with x; ranges that no double holds are cut by x / (1 + |x|)."""
    infinite = F.lit(float("inf"))
    bent = F.when(x == infinite, 1.0).when(x == -infinite, -1.0).otherwise(x / (1 + F.abs(x)))
    share = F.when((hi - lo) < infinite, (x - lo) / (hi - lo)).otherwise((bent + 1) / 2)
    return F.least(F.greatest(F.floor(share * bins), F.lit(0)), F.lit(bins - 1)).cast("int")


def select_ranks(rows: DataFrame, ranks: DataFrame, sizes: DataFrame, bins: int = BINS, passes: int = PASSES) -> DataFrame:
    """(g, v, rank, x): the values of ``rows`` (g, v, x) at ``ranks`` (g, v, rank, from 0); ``sizes`` has lo and hi of every (g, v)."""
    wanted = ranks.join(sizes.select("g", "v", "lo", "hi"), ["g", "v"]).withColumn("base", F.lit(0).cast("long"))
    done, one = [], F.col("lo") == F.col("hi")
    interval = ["g", "v", "lo", "hi"]
    for _ in range(passes):
        wanted = kept(wanted)
        done.append(wanted.where(one).select("g", "v", "rank", F.col("lo").alias("x")))
        wanted = wanted.where(~one)
        if wanted.isEmpty():
            break
        inside = rows.join(wanted.select(*interval).distinct(), ["g", "v"]).where("x between lo and hi")
        counted = inside.groupBy(*interval, _bin(F.col("x"), F.col("lo"), F.col("hi"), bins).alias("bin")).agg(F.count("*").alias("n"), F.min("x").alias("least"), F.max("x").alias("most"))
        upto = F.sum("n").over(Window.partitionBy(*interval).orderBy("bin"))
        wanted = _at_rank(wanted, counted.withColumn("upto", upto), interval).select("g", "v", "rank", F.col("least").alias("lo"), F.col("most").alias("hi"), "below")
        wanted = wanted.withColumnRenamed("below", "base")
    else:
        inside = rows.join(wanted.select(*interval).distinct(), ["g", "v"]).where("x between lo and hi")
        counted = inside.groupBy(*interval, "x").agg(F.count("*").alias("n"))
        upto = F.sum("n").over(Window.partitionBy(*interval).orderBy("x"))
        done.append(_at_rank(wanted, counted.withColumn("upto", upto), interval).select("g", "v", "rank", "x"))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out


def _at_rank(wanted: DataFrame, counted: DataFrame, interval: Sequence[str]) -> DataFrame:
    """``wanted`` with the counted row that holds its rank, and ``below``, how many values stand before that."""
    met = wanted.join(counted, [*interval])
    return met.withColumn("below", F.col("base") + F.col("upto") - F.col("n")).where("rank >= below AND rank < base + upto")
