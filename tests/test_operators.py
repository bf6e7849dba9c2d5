"""Literal cases: ties, nulls, clock changes, invariants."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from isobar.functions import encode, parse, timeops, units
from isobar.operators import asof, boosting, calibrate, ladder, linreg, quantile_gbm, scoring, select, stencil, summarize

T = dt.datetime


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_asof_takes_the_last_of_a_tie_and_keeps_a_null(spark):
    right = spark.createDataFrame([(1, T(2024, 1, 1, 0), 5.0, 1), (1, T(2024, 1, 1, 1), 6.0, 2), (1, T(2024, 1, 1, 1), 7.0, 3), (1, T(2024, 1, 1, 2), None, 4)], "k int, t timestamp_ntz, v double, i int")
    left = spark.createDataFrame([(1, T(2024, 1, 1, 1)), (1, T(2024, 1, 1, 3)), (1, T(2023, 1, 1)), (2, T(2024, 1, 1))], "k int, at timestamp_ntz")
    found = asof.asof_backward(left, right, ["k"], "at", "t", ["v"], tie=["i"])
    assert rows(found.select("k", "at", "v", F.col("matched_at").isNotNull()), "k", "at") == [(1, T(2023, 1, 1), None, False), (1, T(2024, 1, 1, 1), 7.0, True), (1, T(2024, 1, 1, 3), None, True), (2, T(2024, 1, 1), None, False)]
    stale = asof.asof_backward(left, right, ["k"], "at", "t", ["i"], tie=["i"], max_age_hours=1)
    assert [r.i for r in stale.orderBy("k", "at").collect()] == [None, 3, None, None]


@pytest.mark.parametrize("hours", [1, 5, 1000])
def test_bucketed_asof_equals_the_plain_one(spark, hours):
    import random

    rnd = random.Random(hours)
    def some(n):
        return [(rnd.choice([1, 2, None]), T(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 6000)), rnd.choice([None, 1.0, 2.0, 3.0]), i) for i in range(n)]

    right, left = spark.createDataFrame(some(120), "k int, t timestamp_ntz, v double, i int"), spark.createDataFrame(some(80), "k int, at timestamp_ntz, w double, j int")
    for age in (None, 7):
        plain, bucketed = (asof.asof_backward(left, right, ["k"], "at", "t", ["v", "i"], tie=["i"], back_hours=0.5, max_age_hours=age, bucket_hours=h) for h in (None, hours))
        assert rows(plain, "j") == rows(bucketed, "j")


def test_bucketed_windows_equal_the_plain_ones(spark):
    import random

    rnd = random.Random(3)
    df = spark.createDataFrame([(rnd.choice([1, 2]), T(2024, 1, 1) + dt.timedelta(minutes=rnd.randint(0, 6000)), rnd.choice([None, 1.0, 2.0, 3.0]), i) for i in range(200)], "k int, t timestamp_ntz, v double, i int")
    plain, bucketed = (asof.with_trailing(df, {"n": F.count("*"), "m": F.max("v")}, "t", ["k"], 3, h) for h in (None, 4))
    assert rows(plain, "i") == rows(bucketed, "i")
    before, other = (asof.values_before(df, ["i", "v"], "v", "t", ["k"], (1, 5), ["i"], h) for h in (None, 4))
    assert rows(before, "i") == rows(other, "i")
    one, two = (asof.with_previous(df, ["k"], "t", ["i"], ["v", "i"], "p_", h) for h in (None, 4))
    assert rows(one, "i") == rows(two, "i")


def test_no_task_needs_a_whole_hot_key(spark, monkeypatch):
    """Where a key is hot, windows of the as-of family are by key and stretch, or over one row a stretch."""
    monkeypatch.setattr(asof, "HOT_ROWS", 0)
    df = spark.createDataFrame([(1, T(2024, 1, 1), 1.0, 1)], "k int, t timestamp_ntz, v double, i int")
    plans = [asof.asof_backward(df, df, ["k"], "t", "t", ["v"], "x_", ["i"]), asof.with_trailing(df, {"m": F.max("v")}, "t", ["k"], 3), asof.values_before(df, ["i"], "v", "t", ["k"], (1,), ["i"]), asof.with_previous(df, ["k"], "t", ["i"], ["v"], "p_")]
    for plan in plans:
        text = plan._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in text.split("\n") if line.strip().lstrip("+-: ").startswith("Window")]
        assert windows and all("__bucket" in line for line in windows)
        # Windows over the key alone order its stretches.
        assert all("__bucket" in line.rsplit("], [", 2)[-2] or "__bucket" in line.rsplit("], [", 1)[-1] for line in windows)


def test_hot_keys_are_cut_where_they_are_dense(spark, monkeypatch):
    import random

    rnd = random.Random(2)
    def some(n):
        return [(rnd.choice([1, 1, 1, 2, None]), T(2024, 1, 1) + dt.timedelta(seconds=int(rnd.random() ** 6 * 10**7)), rnd.choice([None, 1.0, 2.0]), i) for i in range(n)]

    right, left = spark.createDataFrame(some(900), "k int, t timestamp_ntz, v double, i int"), spark.createDataFrame(some(300), "k int, at timestamp_ntz, w double, j int")
    plain = rows(asof.asof_backward(left, right, ["k"], "at", "t", ["v", "i"], tie=["i"], bucket_hours=None), "j")
    one = rows(asof.with_previous(right, ["k"], "t", ["i"], ["v", "i"], "p_", None), "i")
    monkeypatch.setattr(asof, "HOT_ROWS", 100)
    assert rows(asof.asof_backward(left, right, ["k"], "at", "t", ["v", "i"], tie=["i"]), "j") == plain
    assert rows(asof.with_previous(right, ["k"], "t", ["i"], ["v", "i"], "p_"), "i") == one
    dealt = asof.in_stretches(right.withColumn("t", F.unix_micros(F.col("t").cast("timestamp"))), ["k"], "t", asof.COUNTED)
    sizes = {(r.k, r["__bucket"]): r["count"] for r in dealt.groupBy("k", "__bucket").count().collect()}
    assert max(sizes.values()) <= 200 and sum(sizes.values()) == 900 and len([k for k in sizes if k[0] == 1]) > 5


def test_window_before_reaches_as_far_as_its_hours(spark):
    obs = spark.createDataFrame([(1, T(2024, 1, d, 12), float(d)) for d in range(1, 8)], "k int, t timestamp_ntz, v double").withColumn("own", F.col("t").cast("date"))
    days = spark.createDataFrame([(1, dt.date(2024, 1, 7), T(2024, 1, 7, 13))], "k int, day date, c timestamp_ntz")
    for hours, n in ((24, 1), (30, 2), (100, 5), (1000, 7)):
        assert asof.window_before(obs, days, ["k"], "t", "c", hours, {"n": F.count("*")}, "day", F.col("own")).first().n == n
    with pytest.raises(ValueError):
        asof.window_before(obs, days, ["k"], "t", "c", 48, {"n": F.count("*")}, "day", F.col("own"), days_back=1)


def test_normal_distribution_function(spark):
    import math

    xs = [k / 8 for k in range(-48, 49)]
    got = {r.x: r.p for r in spark.createDataFrame([(x,) for x in xs], "x double").select("x", ladder.phi(F.col("x")).alias("p")).collect()}
    assert all(abs(got[x] - 0.5 * (1 + math.erf(x / math.sqrt(2)))) < 1e-7 for x in xs)


def test_value_before_keeps_the_matched_null(spark):
    df = spark.createDataFrame([(1, T(2024, 1, 1, 0), None), (1, T(2024, 1, 1, 1), 2.0), (1, T(2024, 1, 1, 2), 3.0)], "k int, t timestamp_ntz, v double")
    assert [r.b for r in df.select("t", asof.value_before("v", "t", ["k"], 1).alias("b")).orderBy("t").collect()] == [None, None, 2.0]


def test_cutoff_on_days_of_clock_change(spark):
    days = spark.createDataFrame([(dt.date(2024, 3, 10),), (dt.date(2024, 3, 11),), (dt.date(2024, 11, 3),), (dt.date(2024, 11, 4),)], "d date")
    assert [r.c for r in days.select("d", timeops.cutoff(F.col("d")).alias("c")).orderBy("d").collect()] == [T(2024, 3, 10, 5, 5), T(2024, 3, 11, 4, 5), T(2024, 11, 3, 4, 5), T(2024, 11, 4, 5, 5)]


def test_running_max_skips_nulls(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (1, 2, None), (1, 3, 2.0)], "k int, i int, v double")
    assert [r.m for r in df.select("i", summarize.running_max("v", ["k"], ["i"]).alias("m")).orderBy("i").collect()] == [3.0, None, 3.0]


def test_checkpoint_rules(spark):
    df = spark.createDataFrame([(1, 6, 1, None), (1, 6, 2, 4.0), (1, 6, 3, None), (1, 9, 4, 8.0)], "k int, h int, i int, v double")
    got = {rule: tuple(summarize.checkpoints(df, ["k"], "h", "v", F.col("i"), (6, 9, 12), rule).first()) for rule in ("first_non_null", "first_row", "last_row")}
    assert got == {"first_non_null": (1, 4.0, 8.0, None, 2, 1), "first_row": (1, None, 8.0, None, 2, 2), "last_row": (1, None, 8.0, None, 2, 2)}


def test_stable_mode_takes_the_least_of_equals(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",)], "x string")
    assert df.agg(summarize.stable_mode("x")).first()[0] == "a"


def test_merged_ranges(spark):
    df = spark.createDataFrame([(1, 0, 10), (1, 5, 8), (1, 12, 20), (1, 30, 31)], "k int, s int, e int")
    assert rows(summarize.merge_ranges(df, ["k"], "s", "e", 4), "s") == [(1, 0, 20, 3), (1, 30, 31, 1)]


def _quantiles(spark, *values):
    return ladder.with_bounds(spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(values)], "k int, " + ", ".join(f"{t} double" for t in ladder.TAGS)))


def test_ladder_mass_is_one_and_tails_are_spread(spark):
    df = _quantiles(spark, (66, 67, 69, 71, 73, 75, 76), (70,) * 7, (70, 70, 70, 71, 71, 71, 71), (70.5,) * 7)
    found = ladder.interpolated_ladder(df, ["k"])
    sums = rows(found.groupBy("k").agg(F.round(F.sum("probability"), 9), F.min("probability") >= 0), "k")
    assert sums == [(k, 1.0, True) for k in range(4)]
    below, above = found.where("k = 0").agg(F.sum(F.when(F.col("temp_f") < 66, F.col("probability"))), F.sum(F.when(F.col("temp_f") > 76, F.col("probability")))).first()
    assert abs(below - 0.05 * 1.0) < 0.01 and abs(above - 0.05) < 0.01
    assert rows(found.where("k = 1 and probability > 0").select("temp_f", "probability")) == [(70, 1.0)]
    assert rows(found.where("k = 3 and probability > 0").select("temp_f")) == [(70,)]  # half to even
    for other in (ladder.normal_ladder(df, ["k"]), ladder.smoothed(found, ["k"]), ladder.widened(found, ["k"], 1.5)):
        assert rows(other.groupBy("k").agg(F.round(F.sum("probability"), 9)), "k") == [(k, 1.0) for k in range(4)]


def test_a_quantile_a_last_bit_below_the_one_before_it(spark):
    # the piece starts at the larger of the two, with the larger level, as the ladder's SQL has it
    row = (60.27700000000001, 60.277, 61.14375, 62.3255, 63.38175, 64.8383, 68.79065)
    at = ladder._cdf(F.col("at"), ladder.TAGS, ladder.LEVELS)
    df = spark.createDataFrame([(*row, x) for x in (60.0, 60.5, 63.0, 70.0)], ", ".join(f"{t} double" for t in ladder.TAGS) + ", at double")
    want = [0.05, 0.1 + (60.5 - row[0]) * 0.15 / (row[2] - row[0]), 0.5 + (63.0 - row[3]) * 0.25 / (row[4] - row[3]), 0.95]
    assert [r.p for r in df.select(at.alias("p")).collect()] == want


def test_sums_of_a_ladder_do_not_hang_on_the_order_of_its_rows(spark):
    terms = [(k, t, 10.0 ** -(t % 9) / 3 + k / 7) for k in range(20) for t in range(40)]
    schema = "k int, temp_f int, probability double"
    ways = [spark.createDataFrame(w, schema).coalesce(1) for w in (terms, terms[::-1], sorted(terms, key=lambda r: (r[1] * 7 % 40, r[0])))]
    one, *others = [rows(ladder.normalised(w, ["k"]), "k", "temp_f") for w in ways]
    assert all(o == one for o in others)
    small = [w.withColumn("probability", F.col("probability") / 50) for w in ways]
    one, *others = [rows(calibrate.bucket_factors(w, F.col("temp_f") == 3), "bucket") for w in small]
    assert all(o == one for o in others)


def test_truncation_leaves_the_top_bin(spark):
    df = spark.createDataFrame([(1, t, 0.25, 70.5) for t in (68, 69, 70, 71)], "k int, temp_f int, probability double, so_far double")
    bins = spark.createDataFrame([("68 or below", None, 68), ("69-70", 69, 70), ("71+", 71, None)], "name string, lower int, upper int")
    assert rows(ladder.bin_mass(ladder.truncated(df, ["k"], "so_far"), bins, ["k"]), "name") == [(1, "68 or below", 0.0), (1, "69-70", 0.0), (1, "71+", 1.0)]


def test_scores_of_a_sure_ladder(spark):
    df = spark.createDataFrame([(1, 70, 0.0, 71), (1, 71, 1.0, 71), (2, 70, 0.5, 71), (2, 71, 0.5, 71), (3, 70, 1.0, 90)], "k int, temp_f int, probability double, o int")
    got = {r.k: r for r in scoring.ladder_scores(df, ["k"], "o").collect()}
    assert (got[1].nll, got[1].brier, got[1].rps, got[1].modal_hit) == (0.0, 0.0, 0.0, True)
    assert got[2].brier == 0.5 and got[2].modal_f == 70
    assert got[3].observed_probability == 0.0 and abs(got[3].nll - 27.631) < 1e-2


def test_bucket_edges(spark):
    df = spark.createDataFrame([(0.0,), (0.1,), (0.1 + 0.2,), (0.31,), (1.0,)], "p double")
    assert [r.b for r in df.select("p", scoring.probability_bucket(F.col("p")).alias("b")).orderBy("p").collect()] == [1, 1, 3, 4, 10]


def test_conformal_rank(spark):
    df = spark.createDataFrame([(1, float(y), 0.0, 0.0) for y in range(1, 10)], "k int, y double, lo double, hi double")
    assert rows(calibrate.conformal(df, "y", "lo", "hi", 0.2, ["k"]), "k") == [(1, 9, 8.0)]
    assert tuple(calibrate.conformal_exact(df, "y", "lo", "hi", 0.2).first()) == (9, 8.0)
    assert calibrate.conformal_exact(df.limit(0), "y", "lo", "hi", 0.2).count() == 0


def test_calibration_moves_the_median(spark):
    df = spark.createDataFrame([(dt.date(2024, 1 + i % 12, 1), 70.0 + i % 5, *[65.0 + j for j in range(7)]) for i in range(200)], "day date, y double, " + ", ".join(f"{t} double" for t in ladder.TAGS))
    for name, apply in calibrate.methods(df, "y").items():
        found = apply(df)
        off = found.agg(F.percentile(F.col("y") - F.col("q50"), 0.5)).first()[0]
        assert abs(off) < 1e-9 or name in ("none", "half")
        assert set(ladder.TAGS) <= set(found.columns) and found.count() == 200


def test_regimes_and_weights(spark):
    df = spark.createDataFrame([(70.0, 70.5, 70.0, 70.9), (70.0, 73.0, 70.0, 66.0), (70.0, 70.0, 70.0, 74.0), (70.0, 70.0, 70.0, 66.0), (70.0, 72.0, 70.5, 70.0), (70.0, None, 70.0, 70.0), (68.0, 72.5, 70.0, 70.0)], "n double, v double, l double, h double")
    got = [r.r for r in df.select(encode.regime(*[F.col(c) for c in "nvlh"]).alias("r")).collect()]
    assert got == ["tight_consensus", "native_warm_hrrr_cold", "hrrr_hot_outlier", "hrrr_cold_outlier", "moderate_disagreement", "unknown", "broad_disagreement"]


def test_vocabularies(spark):
    df = spark.createDataFrame([("RA",), ("Light Snow / Windy",), ("fair",), (None,), ("???",), (" ",)], "x string")
    assert [r.t for r in df.select(encode.weather_token(F.col("x")).alias("t")).collect()] == ["RAIN", "SNOW", "NONE", "__MISSING__", "__UNK__", "NONE"]
    learned = encode.learned_ids(spark.createDataFrame([("b",), ("a",), (None,)], "x string"), "x", "i")
    assert {r.x: r.i for r in learned.collect()} == {"a": 0, "b": 1, None: -1}


def test_metar_and_units(spark):
    df = spark.createDataFrame([("RMK T01561083", 1.0), ("RMK T10331050", 1.0), ("none", 7.0)], "r string, t double")
    assert [r.c for r in df.select(parse.metar_temperature_c(F.col("r"), F.col("t")).alias("c")).collect()] == [15.6, -3.3, 7.0]
    one = spark.range(1)
    assert one.select(units.half_even_degree(F.lit(70.5)), units.half_up_degree(F.lit(70.5)), units.wind_direction(F.lit(0.0), F.lit(0.0)), units.wind_direction_hourly(F.lit(0.0), F.lit(0.0))).first()[:] == (70, 71, None, 180.0)
    assert units.convert_by_suffix(spark.createDataFrame([(273.15, 1)], "tmp_k double, n int")).first().asDict() == {"tmp_f": 32.0, "n": 1}


def test_selection_guards(spark):
    df = spark.createDataFrame([("a", 1.000, 2.00), ("b", 1.004, 1.90), ("c", 1.010, 1.00), ("d", 1.003, 1.99)], "id string, loss double, high double")
    assert select.guarded(df, "loss", "high", ["id"]).first().id == "b"
    kept = select.guarded_against(df, F.col("id") == "a", {"loss": ("le", 0.01), "high": ("le", 0.0)}, ["high"])
    assert kept.first().id == "c"
    offers = spark.createDataFrame([(1, 0.9, 5.0, 1), (1, 0.8, 5.0, 2), (1, 0.1, 5.0, 3)], "k int, p double, s double, i int")
    assert rows(select.running_take(offers, ["k"], "p", "s", 7.0, 0.2, ["i"]).select("i", "filled"), "i") == [(1, 5.0), (2, 2.0)]


def test_least_squares_and_boosting(spark):
    df = spark.createDataFrame([(float(i), float(i % 7), 3.0 + 2 * i - (i % 7)) for i in range(100)] + [(None, 1.0, 5.0)], "a double, b double, y double")
    assert [round(c, 6) for c in linreg.fit(df, "y", ["a", "b"])] == [3.0, 2.0, -1.0]
    model = quantile_gbm.fit(df, "y", ["a", "b"], levels=(0.1, 0.5, 0.9), rounds=5)
    flat = quantile_gbm.fit(df, "y", ["a", "b"], levels=(0.1, 0.5, 0.9), rounds=0)
    for q in (0.1, 0.5, 0.9):
        mine, base = df.agg(scoring.pinball(F.col("y"), model.predict(q), q), scoring.pinball(F.col("y"), flat.predict(q), q)).first()
        assert mine < 0.7 * base
    empty = quantile_gbm.fit(df.limit(0), "y", ["a"], levels=(0.5,), rounds=2)
    assert df.select(empty.predict(0.5).alias("p")).first().p == 0.0


def test_stencil_on_cells(spark):
    cells = spark.createDataFrame([("t", r, c, float(r * 3 + c)) for r in range(3) for c in range(3) if (r, c) != (1, 1)], "f string, row int, col int, value double")
    points = spark.createDataFrame([("t", 1, 1), ("t", 0, 0)], "f string, row int, col int")
    got = {(r.at_row, r.at_col): r for r in stencil.at_points(cells, points, ["f"], 1).collect()}
    assert (got[1, 1].n, got[1, 1].mean, got[1, 1].west_east, got[1, 1].south_north) == (8, 4.0, 2.0, -6.0)
    assert got[0, 0].n == 3 and got[0, 0].max == 3.0


def test_nearest_cell(spark):
    cells = spark.createDataFrame([(r, c, 40 + r * 0.1, -74 + c * 0.1) for r in range(20) for c in range(20)], "row int, col int, lat double, lon double")
    points = spark.createDataFrame([("x", 40.77, -73.88)], "id string, lat double, lon double")
    assert stencil.nearest_cell(cells, points, ["id"]).select("row", "col").first()[:] == (8, 1)


@pytest.mark.parametrize("label,bounds", [("68 or below", (None, 68)), ("71+", (71, None)), ("between 69 and 70", None), ("under 40", (None, 39)), ("x", None)])
def test_event_bins(spark, label, bounds):
    got = spark.range(1).select(parse.event_bin(F.lit(label)).alias("b")).first().b
    assert (got and tuple(got)) == bounds


def test_times_from_numbers_and_text(spark):
    given = ["1704067200", "2024-01-01T00:00:00Z", "2024-01-01 00:00:00", "2023-12-31T19:00:00-05:00", "soon", None]
    df = spark.createDataFrame([(x,) for x in given], "x string")
    assert [r.t for r in df.select(parse.time_of(F.col("x")).alias("t")).collect()] == [T(2024, 1, 1)] * 4 + [None] * 2


def test_boosting_on_cells_equals_boosting_on_rows(spark):
    """The stumps of the cells are those that every row's residual gives, and they lower the loss."""
    import numpy as np

    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (400, 2)).astype(float)
    y = np.where(x[:, 0] > 4, 3.0, -1.0) + 0.5 * x[:, 1] + rng.normal(size=400)
    w = rng.integers(1, 4, 400).astype(float)
    df = spark.createDataFrame([(float(p[0]), None if i % 37 == 0 else float(p[1]), float(y[i]), float(w[i])) for i, p in enumerate(x)], "a double, b double, y double, w double")
    model = boosting.fit(df, "y", ["a", "b"], rounds=15, bins=8, weight=F.col("w"))
    table = df.select("a", "b", "y", "w", model.predict().alias("p")).toPandas()
    guess = np.full(400, np.average(y, weights=w))
    a, b = table["a"].to_numpy(), table["b"].to_numpy()
    before = np.average((y - guess) ** 2, weights=w)
    for feature, edge, left, right in model.stumps:
        below = (a if feature == "a" else np.nan_to_num(b, nan=np.inf)) <= edge
        r = w * (y - guess)
        assert abs(left - 0.1 * r[below].sum() / (w[below].sum() + 1)) < 1e-9 and abs(right - 0.1 * r[~below].sum() / (w[~below].sum() + 1)) < 1e-9
        guess = guess + np.where(below, left, right)
    assert np.allclose(guess, table["p"]) and np.average((y - guess) ** 2, weights=w) < 0.5 * before
    assert boosting.fit(df.limit(0), "y", ["a", "b"]).stumps == []


def test_promotion_keeps_the_baseline_if_all_lose(spark):
    summary = spark.createDataFrame([("base", 2.0), ("a", 1.0)], "method string, loss double")
    slices = spark.createDataFrame([("base", "overall", 0.5), ("a", "overall", 0.1)], "method string, slice string, p double")
    found = select.promoted(summary, slices, "method", "base", ["loss"], ("overall",), "p", 0.02).first()
    assert (found.method, found.rejected) == ("base", 1)


def test_a_repeated_key_is_an_error(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "k int, v int")
    with pytest.raises(Exception, match="repeated key"):
        summarize.unique_or_error(df, ["k"]).collect()


def test_a_tie_is_rounded_by_the_double_of_its_product(spark):
    from isobar.plans.registry import places

    values = spark.createDataFrame([(1, 0.0585), (2, 0.058499999999999996), (3, 0.05849), (4, -0.0585), (5, None)], "k int, x double")
    assert rows(values.select("k", places("x", 3)), "k") == [(1, 0.059), (2, 0.059), (3, 0.058), (4, -0.059), (5, None)]


def test_a_box_takes_longitudes_of_two_conventions_only(spark):
    cells = spark.createDataFrame([(1, 0, 0, 42.0, 285.0), (1, 0, 1, 42.0, -75.0), (1, 0, 2, 42.0, 645.0), (1, 0, 3, 42.0, -435.0)], "k int, row int, col int, lat double, lon double")
    found = summarize.crop_box(cells, ["k"], (41.0, 44.0), (-80.0, -70.0)).first()
    assert (found.col_first, found.col_last, found.n_cells) == (0, 1, 2)
