"""Predictions, ladders, scores, calibration and guards, over quantiles of events.

A prediction is a (station, event_type) pair: quantiles of its values on a
temperature scale, and its last value as what was observed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions import encode
from isobar.operators import calibrate, ladder, linreg, scoring, select
from isobar.operators.ladder import IQR_Z, LEVELS, P90_Z, TAGS
from isobar.operators.order_stats import quantiles
from isobar.plans.registry import OBS, observations, places, query, rounded
from isobar.session import scratch_path

KEY = ["station", "event_type"]
#: What sets a ladder's bounds: equal values may leave the quantiles between them beside these by a last bit.
ENDS = ("q05", "q95")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("value") / 10 + 60
    obs = observations(spark, sf_dir).where("value IS NOT NULL")
    found = quantiles(obs, KEY, {"q": t}, {"q": LEVELS}, [F.max_by(t, F.struct("ts", "event_id")).alias("y"), F.count("*").alias("n_obs")])
    return found.select(*KEY, *[F.col("q")[k].alias(tag) for k, tag in enumerate(TAGS)], "y", "n_obs", F.bround("y", 0).cast("int").alias("observed_f"))


_quantiles = ", ".join(f"quantile_cont(value / 10 + 60, {level}) AS {tag}" for level, tag in zip(LEVELS, TAGS, strict=True))
PRED = f"""{OBS}, pred AS (
    SELECT station, event_type, {_quantiles}, arg_max(value / 10 + 60, (ts, event_id)) AS y, count(*) AS n_obs, CAST(round_even(arg_max(value / 10 + 60, (ts, event_id)), 0) AS INTEGER) AS observed_f
    FROM obs WHERE value IS NOT NULL GROUP BY station, event_type
)"""
_knots = " UNION ALL ".join(f"SELECT station, event_type, {tag} AS v, {level} AS p FROM pred" for level, tag in zip(LEVELS, TAGS, strict=True))


def _cdf_sql(x: str) -> str:
    return f"CASE WHEN {x} < q05 THEN p_first WHEN {x} >= q95 THEN 0.95 ELSE {x[0]}lp + ({x} - {x[0]}lx) * ({x[0]}rp - {x[0]}lp) / ({x[0]}rx - {x[0]}lx) END"


LADDER = f"""{PRED}, knots AS (SELECT station, event_type, v, max(p) AS p FROM ({_knots}) GROUP BY ALL),
degrees AS (SELECT *, unnest(range(low, high + 1)) AS temp_f FROM (SELECT *, CAST(floor(q05) AS INTEGER) - 8 AS low, CAST(ceil(q95) AS INTEGER) + 8 AS high FROM pred)),
edges AS (SELECT d.station, d.event_type, d.temp_f, any_value(d.q05) AS q05, any_value(d.q95) AS q95, any_value(d.low) AS low, any_value(d.high) AS high, any_value(d.observed_f) AS observed_f,
    min(k.p) FILTER (k.v = d.q05) AS p_first,
    max(k.v) FILTER (k.v <= d.temp_f + 0.5) AS ulx, max(k.p) FILTER (k.v <= d.temp_f + 0.5) AS ulp, min(k.v) FILTER (k.v > d.temp_f + 0.5) AS urx, arg_min(k.p, k.v) FILTER (k.v > d.temp_f + 0.5) AS urp,
    max(k.v) FILTER (k.v <= d.temp_f - 0.5) AS llx, max(k.p) FILTER (k.v <= d.temp_f - 0.5) AS llp, min(k.v) FILTER (k.v > d.temp_f - 0.5) AS lrx, arg_min(k.p, k.v) FILTER (k.v > d.temp_f - 0.5) AS lrp
    FROM degrees d JOIN knots k ON k.station = d.station AND k.event_type = d.event_type GROUP BY d.station, d.event_type, d.temp_f),
sides AS (SELECT *, temp_f + 0.5 AS u, temp_f - 0.5 AS l, count(*) FILTER (temp_f < q05) OVER w AS n_below, count(*) FILTER (temp_f > q95) OVER w AS n_above FROM edges WINDOW w AS (PARTITION BY station, event_type)),
mass AS (SELECT station, event_type, temp_f, observed_f, CASE WHEN q05 = q95 THEN CASE WHEN temp_f = round_even(q05, 0) THEN 1.0 ELSE 0 END ELSE
    greatest({_cdf_sql("u")} - ({_cdf_sql("l")}), 0) + CASE WHEN n_below > 0 THEN CASE WHEN temp_f < q05 THEN p_first / n_below ELSE 0 END WHEN temp_f = low THEN p_first ELSE 0 END
    + CASE WHEN n_above > 0 THEN CASE WHEN temp_f > q95 THEN (1 - 0.95) / n_above ELSE 0 END WHEN temp_f = high THEN 1 - 0.95 ELSE 0 END END AS m FROM sides),
ladder AS (SELECT station, event_type, CAST(temp_f AS INTEGER) AS temp_f, observed_f, m / sum(m) OVER (PARTITION BY station, event_type) AS probability FROM mass)"""


def ladders(spark: SparkSession, sf_dir: str, keys: tuple[str, ...] = ("observed_f",)) -> DataFrame:
    """The interpolated ladder with the keys of its prediction."""
    pred = ladder.with_bounds(predictions(spark, sf_dir), ENDS)
    return ladder.interpolated_ladder(pred, [*KEY, *keys])


@query(f"WITH {LADDER} SELECT station, event_type, temp_f, round(probability, 6) AS probability FROM ladder")
def degree_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladders(spark, sf_dir).select(*KEY, "temp_f", places("probability").alias("probability"))


_phi = "CASE WHEN {x} >= 0 THEN 1.0 - {t} ELSE {t} END"


def _phi_sql(x: str) -> str:
    k = f"(1.0 / (1.0 + 0.2316419 * abs({x})))"
    tail = f"(exp(-({x}) * ({x}) / 2.0) / sqrt(2 * pi()) * {k} * (0.319381530 + {k} * (-0.356563782 + {k} * (1.781477937 + {k} * (-1.821255978 + {k} * 1.330274429)))))"
    return _phi.format(x=f"({x})", t=tail)


NORMAL = f"""{PRED}, widths AS (SELECT *, (q75 - q25) / {IQR_Z} AS a, (q95 - q05) / {P90_Z} AS b FROM pred),
sigmas AS (SELECT *, greatest(coalesce(CASE WHEN a > 0 AND b > 0 THEN (a + b) / 2 WHEN a > 0 THEN a WHEN b > 0 THEN b END, 0.75), 0.75) AS sigma, CAST(floor(q05) AS INTEGER) - 8 AS low, CAST(ceil(q95) AS INTEGER) + 8 AS high FROM widths),
ns AS (SELECT station, event_type, observed_f, (t + 0.5 - q50) / sigma AS u, (t - 0.5 - q50) / sigma AS l, t FROM (SELECT *, unnest(range(low, high + 1)) AS t FROM sigmas)),
nm AS (SELECT station, event_type, observed_f, CAST(t AS INTEGER) AS temp_f, {_phi_sql("u")} - ({_phi_sql("l")}) AS m FROM ns)"""


@query(f"WITH {NORMAL} SELECT station, event_type, temp_f, round(m / sum(m) OVER (PARTITION BY station, event_type), 6) AS probability FROM nm")
def normal_iqr_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ladder.normal_ladder(ladder.with_bounds(predictions(spark, sf_dir), ENDS), KEY)
    return found.select(*KEY, "temp_f", places("probability").alias("probability"))


_smooth = """s AS (SELECT *, 0.25 * coalesce(lag(probability) OVER w, probability) + 0.5 * probability + 0.25 * coalesce(lead(probability) OVER w, probability) AS m FROM ladder WINDOW w AS (PARTITION BY station, event_type ORDER BY temp_f))"""


@query(f"WITH {LADDER}, {_smooth} SELECT station, event_type, temp_f, round(m / sum(m) OVER (PARTITION BY station, event_type), 6) AS probability FROM s")
def smooth_ladder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder.smoothed(ladders(spark, sf_dir), KEY).select(*KEY, "temp_f", places("probability").alias("probability"))


def _widen_sql() -> str:
    import math

    weights = {d: math.exp(-0.5 * d * d) for d in range(-3, 4)}
    total = sum(weights.values())
    terms = []
    for d, w in weights.items():
        side = f"coalesce(lag(probability, {-d}) OVER w, first_value(probability) OVER w)" if d < 0 else f"coalesce(lead(probability, {d}) OVER w, last_value(probability) OVER a)"
        terms.append(f"{w / total!r} * {side if d else 'probability'}")
    return "g AS (SELECT *, " + " + ".join(terms) + " AS m FROM ladder WINDOW w AS (PARTITION BY station, event_type ORDER BY temp_f), a AS (PARTITION BY station, event_type ORDER BY temp_f ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))"


@query(f"WITH {LADDER}, {_widen_sql()} SELECT station, event_type, temp_f, round(m / sum(m) OVER (PARTITION BY station, event_type), 6) AS probability FROM g")
def gaussian_widen(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder.widened(ladders(spark, sf_dir), KEY, 1.0).select(*KEY, "temp_f", places("probability").alias("probability"))


BINS = [("60 or below", None, 60), ("61-63", 61, 63), ("64-66", 64, 66), ("67-70", 67, 70), ("71+", 71, None)]
_bins = "(VALUES " + ", ".join(f"('{n}', {'NULL' if a is None else a}, {'NULL' if b is None else b})" for n, a, b in BINS) + ") b(name, lower, upper)"
_in_bin = "(lower IS NULL OR temp_f >= lower) AND (upper IS NULL OR temp_f <= upper)"


def bins(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(BINS, "name string, lower int, upper int")


@query(f"WITH {LADDER} SELECT station, event_type, name, round(sum(probability), 6) AS probability FROM ladder JOIN {_bins} ON {_in_bin} GROUP BY ALL")
def event_bin_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ladder.bin_mass(ladders(spark, sf_dir), bins(spark), KEY).select(*KEY, "name", places("probability").alias("probability"))


@query(f"""WITH {LADDER}, c AS (SELECT l.*, CASE WHEN temp_f < p.q50 THEN 0 ELSE probability END AS m FROM ladder l JOIN pred p USING (station, event_type)),
t AS (SELECT *, coalesce(m / nullif(sum(m) OVER (PARTITION BY station, event_type), 0), 0) AS p FROM c)
SELECT station, event_type, name, round(sum(p), 6) AS probability FROM t JOIN {_bins} ON {_in_bin} GROUP BY ALL""")
def max_so_far_truncation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pred = ladder.with_bounds(predictions(spark, sf_dir), ENDS).withColumn("so_far", F.col("q50"))
    found = ladder.truncated(ladder.interpolated_ladder(pred, [*KEY, "so_far"]), KEY, "so_far")
    return ladder.bin_mass(found, bins(spark), KEY).select(*KEY, "name", places("probability").alias("probability"))


SCORES = f"""{LADDER}, c AS (SELECT *, sum(probability) OVER (PARTITION BY station, event_type ORDER BY temp_f) AS cdf FROM ladder),
scores AS (SELECT station, event_type, any_value(observed_f) AS observed_f, coalesce(max(probability) FILTER (temp_f = observed_f), 0) AS observed_probability,
    sum((probability - CASE WHEN temp_f = observed_f THEN 1 ELSE 0 END) ** 2) AS brier, avg((cdf - CASE WHEN temp_f >= observed_f THEN 1 ELSE 0 END) ** 2) AS rps, coalesce(sum(probability) FILTER (temp_f < observed_f), 0) AS pit_low,
    max(probability) AS modal_probability FROM c GROUP BY station, event_type)"""
_nll = "-ln(greatest(observed_probability, 1e-12))"


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.ladder_scores(ladders(spark, sf_dir), KEY, "observed_f")


@query(f"WITH {SCORES} SELECT station, event_type, round({_nll}, 5) AS nll, round(brier, 6) AS brier, round(rps, 6) AS rps, round(pit_low, 6) AS pit_low, round(pit_low + 0.5 * observed_probability, 6) AS pit_mid, round(pit_low + observed_probability, 6) AS pit_high, round(modal_probability, 6) AS modal_probability FROM scores")
def ladder_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scored(spark, sf_dir)
    return found.select(*KEY, places("nll", 5).alias("nll"), *[c.alias(n) for n, c in rounded("brier", "rps", "pit_low", "pit_mid", "pit_high", "modal_probability").items()])


@query(f"""WITH {LADDER}, m AS (SELECT station, event_type, name, sum(probability) AS p, bool_or(temp_f = observed_f) AS hit FROM ladder JOIN {_bins} ON {_in_bin} GROUP BY ALL)
SELECT station, event_type, round(sum(p * hit::INT), 6) AS observed_probability, round(sum((p - hit::INT) ** 2), 6) AS brier, round(-ln(greatest(sum(p * hit::INT), 1e-12)), 5) AS nll FROM m GROUP BY ALL""")
def bin_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    masses = ladder.bin_mass(ladders(spark, sf_dir), bins(spark), [*KEY, "observed_f"])
    edges = F.broadcast(bins(spark))
    o = F.col("observed_f")
    hit = (F.col("lower").isNull() | (o >= F.col("lower"))) & (F.col("upper").isNull() | (o <= F.col("upper")))
    inside = masses.join(edges, "name")
    # the observed degree must be on the ladder, else no bin holds it
    found = scoring.bin_scores(inside.join(ladder.with_bounds(predictions(spark, sf_dir), ENDS).select(*KEY, "low", "high"), KEY), KEY, hit & o.between(F.col("low"), F.col("high")))
    return found.select(*KEY, places("observed_probability").alias("observed_probability"), places("brier").alias("brier"), places("nll", 5).alias("nll"))


_bucket = "CAST(least(greatest(ceil(round(probability * 10, 9)), 1), 10) AS BIGINT)"


@query(f"WITH {LADDER} SELECT {_bucket} AS bucket, count(*) AS n, round(avg(probability), 6) AS mean_probability, round(avg(CASE WHEN temp_f = observed_f THEN 1.0 ELSE 0 END), 6) AS observed_share, round(avg(CASE WHEN temp_f = observed_f THEN 1.0 ELSE 0 END) - avg(probability), 6) AS gap FROM ladder GROUP BY 1")
def reliability_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.reliability(ladders(spark, sf_dir), "probability", F.col("temp_f") == F.col("observed_f"))
    return found.select("bucket", "n", *[c.alias(x) for x, c in rounded("mean_probability", "observed_share", "gap").items()])


@query(f"""WITH {LADDER}, b AS (SELECT *, {_bucket} AS bucket FROM ladder), f AS (SELECT bucket, CASE WHEN sum(probability) <= 1e-12 THEN 1 ELSE least(greatest(count(*) FILTER (temp_f = observed_f) / sum(probability), 0.05), 20) END AS factor FROM b GROUP BY bucket),
r AS (SELECT b.*, probability * (1 + 0.5 * (factor - 1)) AS m FROM b JOIN f USING (bucket))
SELECT station, event_type, temp_f, round(m / sum(m) OVER (PARTITION BY station, event_type), 6) AS probability FROM r""")
def bucket_recalibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = scratch_path(spark, "ladder")
    ladders(spark, sf_dir).write.parquet(at)  # read twice: for the factors, and to apply them
    rows = spark.read.parquet(at)
    factors = calibrate.bucket_factors(rows, F.col("temp_f") == F.col("observed_f"))
    return calibrate.recalibrated(rows, factors, KEY, 0.5).select(*KEY, "temp_f", places("probability").alias("probability"))


@query(f"""WITH {SCORES}, s AS (SELECT *, {_nll} AS nll, CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'other' END AS kind, CASE WHEN modal_probability >= 0.15 THEN 'sharp' ELSE 'flat' END AS confidence FROM scores)
SELECT 'all' AS slice, 'all' AS value, count(*) AS n, round(avg(nll), 5) AS nll, round(avg(brier), 6) AS brier FROM s
UNION ALL SELECT 'kind', kind, count(*), round(avg(nll), 5), round(avg(brier), 6) FROM s GROUP BY kind UNION ALL SELECT 'confidence', confidence, count(*), round(avg(nll), 5), round(avg(brier), 6) FROM s GROUP BY confidence""")
def metric_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scored(spark, sf_dir).withColumns({"kind": F.when(F.col("event_type").isin("click", "view"), "web").otherwise("other"), "confidence": F.when(F.col("modal_probability") >= 0.15, "sharp").otherwise("flat")})
    return scoring.sliced(rows, ["kind", "confidence"], [F.count("*").alias("n"), F.round(F.avg("nll"), 5).alias("nll"), F.round(F.avg("brier"), 6).alias("brier")])


@query(f"""WITH {PRED}
SELECT event_type, count(*) AS n, round(avg(greatest(0.05 * (y - q05), -0.95 * (y - q05))) + 1e-9, 6) AS pinball_q05, round(avg(greatest(0.5 * (y - q50), -0.5 * (y - q50))) + 1e-9, 6) AS pinball_q50, round(avg(greatest(0.95 * (y - q95), -0.05 * (y - q95))) + 1e-9, 6) AS pinball_q95,
    round(avg(q95 - q05 + 20 * (greatest(q05 - y, 0) + greatest(y - q95, 0))) + 1e-9, 6) AS interval_90, round(avg(CASE WHEN y BETWEEN q05 AND q95 THEN 1.0 ELSE 0 END) + 1e-9, 6) AS coverage_90, round(avg(abs(y - q50)) + 1e-9, 6) AS mae, round(sqrt(avg((y - q50) ** 2)) + 1e-9, 6) AS rmse FROM pred GROUP BY event_type""")
def pinball_and_interval_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    y = F.col("y")
    found = predictions(spark, sf_dir).groupBy("event_type").agg(
        F.count("*").alias("n"), *[scoring.pinball(y, F.col(ladder.tag(q)), q).alias(f"pinball_{ladder.tag(q)}") for q in (0.05, 0.5, 0.95)], scoring.interval_score(y, F.col("q05"), F.col("q95"), 0.1).alias("interval_90"),
        F.avg(F.when(y.between(F.col("q05"), F.col("q95")), 1.0).otherwise(0.0)).alias("coverage_90"), F.avg(F.abs(y - F.col("q50"))).alias("mae"), F.sqrt(F.avg((y - F.col("q50")) * (y - F.col("q50")))).alias("rmse"),
    )
    # 1e-9 keeps exact ties of the sixth digit on one side whatever the order of the sums
    return found.select("event_type", "n", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in found.columns if c not in ("event_type", "n")])


_noisy = ", ".join(f"{tag} + CASE WHEN station % {k + 2} = 0 THEN 3 ELSE 0 END AS {tag}" for k, tag in enumerate(TAGS))


def _noised(df: DataFrame) -> DataFrame:
    return df.withColumns({tag: F.col(tag) + F.when(F.col("station") % (k + 2) == 0, 3).otherwise(0) for k, tag in enumerate(TAGS)})


@query(f"WITH {PRED}, n AS (SELECT station, event_type, {_noisy} FROM pred) SELECT station, event_type, " + ", ".join(f"round(greatest({', '.join(TAGS[: k + 1])}), 6) AS {tag}" if k else f"round({tag}, 6) AS {tag}" for k, tag in enumerate(TAGS)) + " FROM n")
def monotone_rearrange(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _noised(predictions(spark, sf_dir)).select(*KEY, *ladder.rearranged(TAGS))
    return found.select(*KEY, *[c.alias(x) for x, c in rounded(*TAGS).items()])


_pairs = list(zip(TAGS, TAGS[1:], strict=False))


@query(f"WITH {PRED}, n AS (SELECT station, event_type, {_noisy} FROM pred) SELECT event_type, " + ", ".join(f"count(*) FILTER ({b} < {a}) AS crossed_{a}_{b}" for a, b in _pairs) + f", count(*) FILTER ({' OR '.join(f'{b} < {a}' for a, b in _pairs)}) AS crossed_any FROM n GROUP BY event_type")
def quantile_crossing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _noised(predictions(spark, sf_dir)).groupBy("event_type").agg(*ladder.crossings(TAGS))


_offsets = ", ".join(f"round(quantile_cont(y - {tag}, {level}), 6) AS offset_{tag}" for level, tag in zip(LEVELS, TAGS, strict=True))


@query(f"WITH {PRED} SELECT count(*) AS n, {_offsets} FROM pred")
def quantile_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = calibrate.offsets(predictions(spark, sf_dir), "y")
    return found.select("n", *[c.alias(x) for x, c in rounded(*[f"offset_{t}" for t in TAGS]).items()])


_raw = ", ".join(f"quantile_cont(y - {tag}, {level}) AS o_{tag}" for level, tag in zip(LEVELS, TAGS, strict=True))
_seg = f"{PRED}, g AS (SELECT {_raw} FROM pred), s AS (SELECT event_type, count(*) AS n, {_raw} FROM pred GROUP BY event_type)"


@query(f"WITH {_seg} SELECT event_type, n, {', '.join(f'round(CASE WHEN n >= 60 THEN s.o_{t} ELSE g.o_{t} END, 6) AS offset_{t}' for t in TAGS)} FROM s, g")
def segmented_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = calibrate.segmented_offsets(predictions(spark, sf_dir), "y", "event_type")
    return found.select("event_type", "n", *[c.alias(x) for x, c in rounded(*[f"offset_{t}" for t in TAGS]).items()])


@query(f"WITH {_seg} SELECT event_type, n, {', '.join(f'round(g.o_{t} + least(1.0, n / 120.0) * (s.o_{t} - g.o_{t}), 6) AS offset_{t}' for t in TAGS)} FROM s, g")
def shrunk_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = calibrate.segmented_offsets(predictions(spark, sf_dir), "y", "event_type", shrink=True)
    return found.select("event_type", "n", *[c.alias(x) for x, c in rounded(*[f"offset_{t}" for t in TAGS]).items()])


@query(f"""WITH {PRED}, r AS (SELECT event_type, greatest(q10 - y, y - q90) AS m FROM pred),
k AS (SELECT event_type, m, count(*) OVER w AS n, row_number() OVER (PARTITION BY event_type ORDER BY m) AS i FROM r WINDOW w AS (PARTITION BY event_type))
SELECT event_type, n, round(m, 6) AS margin FROM k WHERE i = least(greatest(ceil(round((n + 1) * 0.8, 9)), 1), n)""")
def conformal_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.conformal(predictions(spark, sf_dir), "y", "q10", "q90", 0.2, ["event_type"]).select("event_type", "n", F.round("margin", 6).alias("margin"))


@query(f"""WITH {PRED}, r AS (SELECT greatest(q05 - y, y - q95) AS m FROM pred), k AS (SELECT m, count(*) OVER () AS n, row_number() OVER (ORDER BY m) AS i FROM r)
SELECT n, round(m, 6) AS margin FROM k WHERE i = least(greatest(ceil(round((n + 1) * 0.9, 9)), 1), n)""")
def conformal_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calibrate.conformal_exact(predictions(spark, sf_dir), "y", "q05", "q95", 0.1).select("n", F.round("margin", 6).alias("margin"))


# --- four sources --------------------------------------------------------------

SOURCES = {"nbm": "click", "native": "view", "lamp": "purchase", "hrrr": "error"}
FRAME = f"""{OBS}, frame AS (
    SELECT station % 10 AS station, date_local, {", ".join(f"avg(value / 10 + 60) FILTER (event_type = '{t}') AS {s}" for s, t in SOURCES.items())}, avg(value / 10 + 60) FILTER (event_type = 'signup') AS y
    FROM obs GROUP BY station % 10, date_local)"""
_all4 = "nbm, native, lamp, hrrr"


def frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    def mean(kind: str) -> Column:
        return F.avg(F.when(F.col("event_type") == kind, F.col("value") / 10 + 60))

    return observations(spark, sf_dir).groupBy((F.col("station") % 10).alias("station"), "date_local").agg(*[mean(t).alias(s) for s, t in SOURCES.items()], mean("signup").alias("y"))


_complete = "nbm IS NOT NULL AND native IS NOT NULL AND lamp IS NOT NULL AND hrrr IS NOT NULL"
REGIME = f"""{FRAME}, mid AS (SELECT *, list_median_4 AS m, greatest({_all4}) - least({_all4}) AS spread FROM (SELECT *, (SELECT median(x) FROM (SELECT unnest([{_all4}]) AS x)) AS list_median_4 FROM frame)),
reg AS (SELECT *, CASE WHEN NOT ({_complete}) THEN 'unknown' WHEN native - hrrr >= 3 AND native - m >= 1 AND hrrr - m <= -1 THEN 'native_warm_hrrr_cold' WHEN hrrr - native >= 3 AND hrrr - m >= 1 AND native - m <= -1 THEN 'native_cold_hrrr_warm'
    WHEN hrrr - greatest(nbm, native, lamp) >= 3 THEN 'hrrr_hot_outlier' WHEN least(nbm, native, lamp) - hrrr >= 3 THEN 'hrrr_cold_outlier' WHEN spread >= 4 THEN 'broad_disagreement' WHEN spread >= 2 THEN 'moderate_disagreement' ELSE 'tight_consensus' END AS regime FROM mid)"""
_high = "('native_warm_hrrr_cold', 'native_cold_hrrr_warm', 'hrrr_hot_outlier', 'hrrr_cold_outlier', 'broad_disagreement')"


def regimes(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir)
    four = [F.col(s) for s in SOURCES]
    return rows.withColumns({"m": encode.row_median(four), "spread": F.greatest(*four) - F.least(*four), "regime": encode.regime(*four)})


@query(f"""WITH {REGIME} SELECT station, date_local, regime, CASE WHEN regime = 'unknown' THEN 'unknown' WHEN spread >= 6 THEN 'very_high' WHEN regime IN {_high} THEN 'high' WHEN regime = 'moderate_disagreement' THEN 'medium' ELSE 'low' END AS risk,
    CAST(CASE WHEN regime IN {_high} THEN 2.0 ELSE 1.0 END AS DOUBLE) AS weight, round(spread, 6) AS spread,
    CASE WHEN nbm - lamp IS NULL THEN '5f_or_more' WHEN abs(nbm - lamp) < 2 THEN 'lt_2f' WHEN abs(nbm - lamp) < 5 THEN '2f_to_5f' ELSE '5f_or_more' END AS bucket,
    CASE WHEN nbm - lamp IS NULL THEN 'unknown' WHEN nbm - lamp >= 3 THEN 'warmer' WHEN nbm - lamp <= -3 THEN 'colder' ELSE 'near' END AS direction FROM reg""")
def source_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("nbm") - F.col("lamp")
    rows = regimes(spark, sf_dir)
    return rows.select("station", "date_local", "regime", encode.risk(F.col("regime"), F.col("spread")).alias("risk"), encode.regime_weight(F.col("regime")).alias("weight"), F.round("spread", 6).alias("spread"), encode.disagreement_bucket(d).alias("bucket"), encode.direction_segment(d).alias("direction"))


@query(f"""WITH {REGIME}, r AS (SELECT *, (nbm IS NOT NULL)::INT + (native IS NOT NULL)::INT + (lamp IS NOT NULL)::INT + (hrrr IS NOT NULL)::INT AS n FROM reg)
SELECT station, date_local, CAST(n AS BIGINT) AS n_sources, round((nbm + lamp) / 2 + 1e-9, 6) AS equal_2way, round((nbm + lamp + hrrr) / 3 + 1e-9, 6) AS equal_3way, round((nbm + native + lamp + hrrr) / 4 + 1e-9, 6) AS equal_4way, round(CASE WHEN n = 4 THEN m END + 1e-9, 6) AS median_4,
    round((nbm + native + lamp + hrrr - greatest({_all4}) - least({_all4})) / 2 * CASE WHEN n = 4 THEN 1 END + 1e-9, 6) AS trimmed,
    CASE WHEN nbm IS NOT NULL THEN CAST(1 + coalesce((native < nbm)::INT, 0) + coalesce((lamp < nbm)::INT, 0) + coalesce((hrrr < nbm)::INT, 0) AS BIGINT) END AS nbm_rank,
    CASE WHEN n > 0 THEN CASE greatest({_all4}) WHEN nbm THEN 'nbm' WHEN native THEN 'native' WHEN lamp THEN 'lamp' ELSE 'hrrr' END END AS warmest FROM r""")
def source_rank_trim_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    four = [F.col(s) for s in SOURCES]
    nbm, native, lamp, hrrr = four
    complete = nbm.isNotNull() & native.isNotNull() & lamp.isNotNull() & hrrr.isNotNull()
    total, top = nbm + native + lamp + hrrr, F.greatest(*four)
    below = sum((F.coalesce((s < nbm).cast("long"), F.lit(0).cast("long")) for s in (native, lamp, hrrr)), F.lit(1).cast("long"))
    warmest = F.coalesce(*[F.when(F.col(s) == top, s) for s in SOURCES])
    return regimes(spark, sf_dir).select(
        "station", "date_local", sum((s.isNotNull().cast("long") for s in four), F.lit(0).cast("long")).alias("n_sources"), F.round((nbm + lamp) / 2 + 1e-9, 6).alias("equal_2way"), F.round((nbm + lamp + hrrr) / 3 + 1e-9, 6).alias("equal_3way"),
        F.round(total / 4 + 1e-9, 6).alias("equal_4way"), F.round(F.when(complete, F.col("m")) + 1e-9, 6).alias("median_4"), F.round((total - top - F.least(*four)) / 2 + 1e-9, 6).alias("trimmed"), F.when(nbm.isNotNull(), below).alias("nbm_rank"), warmest.alias("warmest"),
    )


_grid = [k / 10 for k in range(11)]


@query(f"""WITH {REGIME}, e AS (SELECT station, w, count(*) AS n, round(avg(abs(w * nbm + (1 - w) * lamp - y)), 9) AS mae FROM reg, (SELECT unnest({_grid}) AS w) WHERE y IS NOT NULL AND nbm IS NOT NULL AND lamp IS NOT NULL GROUP BY station, w)
SELECT station, n, CAST(CASE WHEN n >= 20 THEN w ELSE 0.5 END AS DOUBLE) AS weight, CASE WHEN n >= 20 THEN round(mae, 6) END AS mae FROM e QUALIFY row_number() OVER (PARTITION BY station ORDER BY mae, round(abs(w - 0.5), 6), w) = 1""")
def segment_weight_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linreg.weight_grid(frame(spark, sf_dir), "y", "nbm", "lamp", "station", min_rows=20)
    return found.select("station", "n", F.col("weight").cast("double").alias("weight"), F.round("mae", 6).alias("mae"))


@query(f"""WITH {FRAME}, w AS (SELECT * FROM frame WHERE nbm IS NOT NULL AND y IS NOT NULL) SELECT round(regr_intercept(y, nbm), 4) AS intercept, round(regr_slope(y, nbm), 4) AS slope, CAST(regr_count(y, nbm) AS BIGINT) AS n FROM w""")
def ols_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir)
    intercept, slope = linreg.fit(rows, "y", ["nbm"])
    return rows.where("nbm IS NOT NULL AND y IS NOT NULL").agg(F.count("*").alias("n")).select(F.round(F.lit(intercept), 4).alias("intercept"), F.round(F.lit(slope), 4).alias("slope"), "n")


CANDIDATES = f"""{FRAME}, c AS (SELECT candidate, month(date_local) % 2 * 2 + day(date_local) % 2 AS fold, abs(y - x) AS e, nbm, lamp FROM frame, LATERAL (VALUES ('nbm', nbm), ('lamp', lamp), ('half', (nbm + lamp) / 2), ('three', (nbm + lamp + hrrr) / 3)) v(candidate, x) WHERE y IS NOT NULL AND x IS NOT NULL),
folds AS (SELECT candidate, fold, count(*) AS n, avg(e) AS mae, avg(e) FILTER (abs(nbm - lamp) >= 5) AS high_mae FROM c GROUP BY candidate, fold)"""


def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir)
    nbm, lamp, hrrr = F.col("nbm"), F.col("lamp"), F.col("hrrr")
    tried = F.array(*[F.struct(F.lit(n).alias("candidate"), x.alias("x")) for n, x in (("nbm", nbm), ("lamp", lamp), ("half", (nbm + lamp) / 2), ("three", (nbm + lamp + hrrr) / 3))])
    long = rows.select("*", F.explode(tried).alias("c")).select("*", "c.*").where("y IS NOT NULL AND x IS NOT NULL")
    fold = (F.month("date_local") % 2 * 2 + F.day("date_local") % 2).cast("long")
    e = F.abs(F.col("y") - F.col("x"))
    return long.groupBy("candidate", fold.alias("fold")).agg(F.count("*").alias("n"), F.avg(e).alias("mae"), F.avg(F.when(F.abs(nbm - lamp) >= 5, e)).alias("high_mae"))


@query(f"""WITH {CANDIDATES}, s AS (SELECT candidate, sum(mae * n) / sum(n) AS weighted_mean, avg(mae) AS mean, stddev_pop(mae) AS std, count(*) AS folds FROM folds GROUP BY candidate)
SELECT candidate, round(weighted_mean, 6) AS weighted_mean, round(mean, 6) AS mean, round(std, 6) AS std, folds, CAST(rank() OVER (ORDER BY weighted_mean) AS BIGINT) AS rank FROM s""")
def fold_weighted_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scoring.fold_summary(folds(spark, sf_dir), ["candidate"], "mae", "n")
    return found.select("candidate", *[c.alias(x) for x, c in rounded("weighted_mean", "mean", "std").items()], "folds", F.col("rank").cast("long").alias("rank"))


@query(f"""WITH {CANDIDATES}, s AS (SELECT candidate, sum(mae * n) / sum(n) AS loss, avg(high_mae) AS slice_loss FROM folds GROUP BY candidate), b AS (SELECT * FROM s ORDER BY loss, candidate LIMIT 1),
g AS (SELECT s.*, 0 AS tier FROM s, b WHERE s.loss <= b.loss + 0.5 AND s.slice_loss <= b.slice_loss - 0.02 UNION ALL SELECT *, 1 FROM b)
SELECT candidate, round(loss, 6) AS loss, round(slice_loss, 6) AS slice_loss FROM g ORDER BY tier, CASE WHEN tier = 0 THEN slice_loss END, loss, candidate LIMIT 1""")
def guarded_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folds(spark, sf_dir).groupBy("candidate").agg((F.sum(F.col("mae") * F.col("n")) / F.sum("n")).alias("loss"), F.avg("high_mae").alias("slice_loss"))
    return select.guarded(rows, "loss", "slice_loss", ["candidate"], tolerance=0.5).select("candidate", F.round("loss", 6).alias("loss"), F.round("slice_loss", 6).alias("slice_loss"))


_weights = "CASE regime WHEN 'native_cold_hrrr_warm' THEN 0.25 WHEN 'hrrr_cold_outlier' THEN 0.25 WHEN 'hrrr_hot_outlier' THEN 0.65 WHEN 'native_warm_hrrr_cold' THEN 0.65 WHEN 'broad_disagreement' THEN 0.5 WHEN 'moderate_disagreement' THEN 0.5 WHEN 'tight_consensus' THEN 0.35 ELSE 0.5 END"


@query(f"""WITH {REGIME}, w AS (SELECT *, {_weights} AS w, CASE WHEN regime = 'native_cold_hrrr_warm' THEN 0.0 ELSE 1.0 END AS w_except FROM reg)
SELECT station, date_local, CAST(w AS DOUBLE) AS weight, round((1 - w) * (nbm + lamp) / 2 + w * (nbm + lamp + hrrr) / 3 + 1e-9, 6) AS blend_f, round((1 - w_except) * (nbm + lamp) / 2 + w_except * (nbm + lamp + hrrr) / 3 + 1e-9, 6) AS guarded_f FROM w""")
def dual_guard_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = regimes(spark, sf_dir).withColumn("risk", encode.risk(F.col("regime"), F.col("spread")))
    two, three = (F.col("nbm") + F.col("lamp")) / 2, (F.col("nbm") + F.col("lamp") + F.col("hrrr")) / 3

    def blend(policy: str) -> Column:
        w = encode.GUARD_POLICIES[policy](F.col("regime"), F.col("risk"))
        return F.round((1 - w) * two + w * three + 1e-9, 6)

    weight = encode.GUARD_POLICIES["probability_blend_by_regime"](F.col("regime"), F.col("risk"))
    return rows.select("station", "date_local", weight.alias("weight"), blend("probability_blend_by_regime").alias("blend_f"), blend("with_hrrr_except_native_cold_hrrr_warm").alias("guarded_f"))
