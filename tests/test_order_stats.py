"""Exact quantiles by selection, and interval overlaps, against plain versions."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import intervals, order_stats


def _values(rng, n):
    kinds = [lambda: rng.gauss(0, 1), lambda: float(rng.randrange(4)), lambda: 10 ** rng.uniform(-25, 25), lambda: 5.0, lambda: rng.choice([float("inf"), float("-inf"), 1.0, 2.0]), lambda: None, lambda: float("nan")]
    weights = [6, 3, 2, 2, 0.3, 0.5, 0.2]
    return [rng.choices(kinds, weights)[0]() for _ in range(n)]


def test_selection_equals_sorting(spark):
    rng = random.Random(7)
    rows = [(g, x, y) for g, n in ((1, 4000), (2, 300), (None, 50), (3, 1)) for x, y in zip(_values(rng, n), _values(rng, n), strict=True)] + [(4, None, 1.0), (5, None, float("nan"))]
    df = spark.createDataFrame(rows, "g int, x double, y double").repartition(4)
    levels = {"x": (0.0, 0.05, 0.5, 0.95, 1.0), "y": (0.25, 0.5)}
    got = {r.g: r for r in order_stats.quantiles(df, ["g"], {"x": F.col("x"), "y": F.col("y")}, levels, [F.count("*").alias("n"), F.max("y").alias("top")], buffer_rows=10).collect()}
    small = {r.g: r for r in order_stats.quantiles(df, ["g"], {"x": F.col("x"), "y": F.col("y")}, levels, [F.count("*").alias("n")]).collect()}
    assert set(got) == {1, 2, None, 3, 4, 5}
    for g in got:
        own = [r for r in rows if r[0] == g]
        assert got[g].n == len(own) == small[g].n
        for name, place in (("x", 1), ("y", 2)):
            data = np.sort([r[place] for r in own if r[place] is not None and r[place] == r[place]])
            if not len(data):
                assert got[g][name] is None and small[g][name] is None
                continue
            for q, value, other in zip(levels[name], got[g][name], small[g][name], strict=True):
                p = q * (len(data) - 1)
                low, high = data[int(np.floor(p))], data[int(np.ceil(p))]
                want = low if low == high else (1 - (p % 1)) * low + (p % 1) * high
                assert value == pytest.approx(want, rel=1e-12), (g, name, q)
                assert other == pytest.approx(want, rel=1e-12)


@pytest.mark.parametrize("buffer_rows", [5, 100_000])
def test_quantiles_have_the_bits_of_the_sql(spark, buffer_rows):
    import duckdb

    rng = random.Random(3)
    rows = [(g, round(rng.uniform(0, 500), 2)) for g in range(200) for _ in range(rng.randrange(1, 30))]
    levels = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95)
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.q for r in order_stats.quantiles(df, ["g"], {"q": F.col("x") / 10 + 60}, {"q": levels}, buffer_rows=buffer_rows).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(g INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", rows)
    asked = ", ".join(f"quantile_cont(x / 10 + 60, {level})" for level in levels)
    assert got == {g: list(q) for g, *q in con.execute(f"SELECT g, {asked} FROM t GROUP BY g").fetchall()}


@pytest.mark.parametrize("buffer_rows", [5, 100_000])
def test_quantiles_between_equal_values_have_the_bits_of_the_sql(spark, buffer_rows):
    import duckdb

    # ten values of which the two least are one: 0.45 of the way between them is a last bit beside them
    pairs = [(1, x) for x in (2.77, 2.77, 10.0, 12.0, 14.0, 20.0, 30.0, 40.0, 50.0, 60.0)] + [(2, 13.67)] * 10 + [(3, 5.92)] * 11
    df = spark.createDataFrame(pairs, "g int, x double")
    got = {r.g: r.q for r in order_stats.quantiles(df, ["g"], {"q": F.col("x") / 10 + 60}, {"q": (0.05, 0.1, 0.25)}, buffer_rows=buffer_rows).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE t(g INTEGER, x DOUBLE)")
    con.executemany("INSERT INTO t VALUES (?, ?)", pairs)
    want = {g: list(q) for g, *q in con.execute("SELECT g, quantile_cont(x / 10 + 60, 0.05), quantile_cont(x / 10 + 60, 0.1), quantile_cont(x / 10 + 60, 0.25) FROM t GROUP BY g").fetchall()}
    assert got == want and want[1][0] > want[1][1]


def test_all_rows_and_no_rows(spark):
    df = spark.range(1000).select((F.col("id") * 3.0).alias("x"))
    assert order_stats.quantiles(df, [], {"x": F.col("x")}, {"x": [0.5]}, buffer_rows=10).first().x == [pytest.approx(1498.5)]
    assert order_stats.quantiles(df.limit(0), [], {"x": F.col("x")}, {"x": [0.5]}).first().x is None
    assert order_stats.quantiles(df.limit(0).withColumn("g", F.lit(1)), ["g"], {"x": F.col("x")}, {"x": [0.5]}).count() == 0


def test_no_task_gets_the_rows_of_a_group(spark):
    """What stands behind an exchange of a pass is counts by bin."""
    rows = spark.range(200_000, numPartitions=8).select(F.struct(F.lit(1).alias("a")).alias("g"), F.lit(0).alias("v"), F.hash("id").cast("double").alias("x"))
    sizes = rows.groupBy("g", "v").agg(F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
    ranks = sizes.select("g", "v", F.explode(F.array(F.lit(0), F.lit(99_999), F.lit(199_999))).alias("rank"))
    got = {r["rank"]: r.x for r in order_stats.select_ranks(rows, ranks, sizes, bins=64).collect()}
    data = sorted(r.x for r in rows.select("x").collect())
    assert got == {k: data[k] for k in (0, 99_999, 199_999)}
    counted = rows.join(sizes, ["g", "v"]).groupBy("g", "v", order_stats._bin(F.col("x"), F.col("lo"), F.col("hi"), 64).alias("bin")).count()
    assert counted.count() <= 64 and counted.agg(F.sum("count")).first()[0] == 200_000


def _pairs(left, right):
    return sorted(((a[1], b[1], (min(a[3], b[3]) - max(a[2], b[2])).days + 1) for a in left for b in right if a[0] is not None and a[0] == b[0] and None not in (*a[2:], *b[2:]) and a[2] <= a[3] and b[2] <= b[3] and max(a[2], b[2]) <= min(a[3], b[3])))


def test_overlaps_equal_all_pairs(spark):
    rng = random.Random(3)

    def some(n):
        out = []
        for k in range(n):
            start = dt.date(1969, 10, 1) + dt.timedelta(days=rng.randrange(400))
            end = start + dt.timedelta(days=rng.choice([0, 0, 1, 3, 7, 8, 30, 200, -2]))
            out.append((rng.choice(["hot", "hot", "hot", "b", None]), k, None if rng.random() < 0.03 else start, None if rng.random() < 0.03 else end))
        return out

    left, right = some(200), some(150)
    a, b = (spark.createDataFrame(x, "key string, n int, start date, end date") for x in (left, right))
    found = intervals.overlaps(a, b, ["key"], ("start", "end"), ("start", "end"))
    assert sorted((r.left.n, r.right.n, r.covered) for r in found.collect()) == _pairs(left, right)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert intervals.overlaps(a.limit(0), b, ["key"], ("start", "end"), ("start", "end")).count() == 0


def test_overlaps_of_instants(spark):
    at = dt.datetime(2024, 1, 1)
    a = spark.createDataFrame([(1, at, at + dt.timedelta(hours=5))], "k int, s timestamp_ntz, e timestamp_ntz")
    b = spark.createDataFrame([(1, at + dt.timedelta(hours=5), at + dt.timedelta(days=900)), (1, at - dt.timedelta(hours=1), at - dt.timedelta(microseconds=1))], "k int, s timestamp_ntz, e timestamp_ntz")
    assert [r.covered for r in intervals.overlaps(a, b, ["k"], ("s", "e"), ("s", "e")).collect()] == [1]
