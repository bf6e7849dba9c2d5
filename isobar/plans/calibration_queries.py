"""Calibration appliers and promotions, blends and ridge, slices of scores, folds by candidates, logs and gates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import calibrate, folds, ladder, linreg, scoring, select
from isobar.operators.ladder import LEVELS, TAGS
from isobar.operators.order_stats import kept
from isobar.plans.forecast_queries import CANDIDATES, ENDS, FRAME, KEY, LADDER, PRED, REGIME, SCORES, frame, ladders, predictions, regimes, scored
from isobar.plans.forecast_queries import folds as candidate_folds
from isobar.plans.model_queries import ORIGINS, _origins
from isobar.plans.registry import OBS, observations, query, rounded, table

# --- appliers --------------------------------------------------------------------

# A prediction's day stands for its season; its regime for how its sources agree.
_day = "DATE '2024-01-01' + CAST(station % 366 AS INTEGER)"
_regime = "CASE station % 4 WHEN 0 THEN 'tight_consensus' WHEN 1 THEN 'moderate_disagreement' WHEN 2 THEN 'broad_disagreement' END"
_off = ", ".join(f"quantile_cont(y - {t}, {level}) AS o_{t}" for t, level in zip(TAGS, LEVELS, strict=True))
FITTED = f"""{PRED}, d AS (SELECT *, {_day} AS day, {_regime} AS regime, CASE WHEN month({_day}) BETWEEN 4 AND 10 THEN 'warm' ELSE 'cool' END AS season FROM pred),
g AS (SELECT {_off} FROM d), s AS (SELECT season, count(*) AS n, {_off} FROM d GROUP BY season)"""


def _dated(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("station") % 4
    regime = F.when(k == 0, "tight_consensus").when(k == 1, "moderate_disagreement").when(k == 2, "broad_disagreement")
    return predictions(spark, sf_dir).withColumns({"day": F.date_add(F.lit("2024-01-01").cast("date"), (F.col("station") % 366).cast("int")), "regime": regime})


def _applied(spark: SparkSession, sf_dir: str, name: str, segments: tuple[str, ...] = (), regime: str | None = None) -> DataFrame:
    df = kept(_dated(spark, sf_dir))  # read by every fit, and to apply them
    found = calibrate.methods(df, "y", segments, regime)[name](df)
    return found.select(*KEY, *[F.round(F.col(t) + 1e-9, 6).alias(t) for t in TAGS])


def _monotone(values: dict[str, str]) -> str:
    return ", ".join(f"round(greatest({', '.join(values[x] for x in TAGS[: k + 1])}) + 1e-9, 6) AS {t}" for k, t in enumerate(TAGS))


@query(f"WITH {FITTED} SELECT station, event_type, {_monotone({t: f'd.{t} + g.o_{t}' for t in TAGS})} FROM d, g")
def global_offsets_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, "global")


@query(f"WITH {FITTED} SELECT station, event_type, {_monotone({t: f'd.{t} + CASE WHEN s.n >= 60 THEN s.o_{t} ELSE g.o_{t} END' for t in TAGS})} FROM d JOIN s USING (season), g")
def segmented_offsets_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, "season", ("season",))


@query(f"WITH {FITTED} SELECT station, event_type, {_monotone({t: f'd.{t}' if t in calibrate.UPPER_TAIL else f'd.{t} + g.o_{t}' for t in TAGS})} FROM d, g")
def lower_offsets_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, "lower")


def _margin(low: str, high: str, alpha: float) -> str:
    return f"(SELECT m FROM (SELECT greatest({low} - y, y - {high}) AS m, count(*) OVER () AS n, row_number() OVER (ORDER BY greatest({low} - y, y - {high})) AS i FROM d) WHERE i = least(greatest(ceil(round((n + 1) * {1 - alpha}, 9)), 1), n)) AS m_{low}"


_wide = {t: f"d.{t} - c.m_{low}" for (low, high) in calibrate.INTERVALS for t in (low,)} | {high: f"d.{high} + c.m_{low}" for (low, high) in calibrate.INTERVALS} | {"q50": "d.q50 + g.o_q50"}


@query(f"WITH {FITTED}, c AS (SELECT {', '.join(_margin(*pair, alpha) for pair, alpha in calibrate.INTERVALS.items())}) SELECT station, event_type, {_monotone(_wide)} FROM d, g, c")
def conformal_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _applied(spark, sf_dir, "conformal")


@query(f"WITH {FITTED} SELECT station, event_type, {_monotone({t: f'd.{t} + CASE WHEN regime IN {calibrate.CONSENSUS} THEN 0.5 ELSE 1 END * g.o_{t}' for t in TAGS})} FROM d, g")
def conditional_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consensus regimes by half of the offsets, all others, and unknown ones, by the whole."""
    return _applied(spark, sf_dir, "conditional", regime="regime")


GRID = (0.0, 0.25, 0.5, 0.75, 1.0)
_bucket = "CAST(least(greatest(ceil(round(probability * 10, 9)), 1), 10) AS BIGINT)"


@query(f"""WITH {LADDER}, b AS (SELECT *, {_bucket} AS bucket FROM ladder), f AS (SELECT bucket, CASE WHEN sum(probability) <= 1e-12 THEN 1 ELSE least(greatest(count(*) FILTER (temp_f = observed_f) / sum(probability), 0.05), 20) END AS factor FROM b GROUP BY bucket),
r AS (SELECT station, event_type, s, coalesce(sum(probability * (1 + s * (factor - 1))) FILTER (temp_f = observed_f), 0) / sum(probability * (1 + s * (factor - 1))) AS p FROM b JOIN f USING (bucket), (SELECT unnest({list(GRID)}::DOUBLE[]) AS s) GROUP BY ALL)
SELECT s AS shrinkage, count(*) AS n, round(avg(-ln(greatest(p, 1e-12))), 5) AS nll FROM r GROUP BY s""")
def shrinkage_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ladders(spark, sf_dir)
    hit = F.col("temp_f") == F.col("observed_f")
    return calibrate.shrinkage_grid(rows, calibrate.bucket_factors(rows, hit), KEY, hit, GRID).select("shrinkage", "n", F.round("nll", 5).alias("nll"))


# --- promotion -------------------------------------------------------------------

#: Types of events stand for methods of calibration; views are the baseline.
_methods = f"""{OBS}, m AS (SELECT event_type AS method, value, CASE k % 4 WHEN 0 THEN 'tight_consensus' WHEN 1 THEN 'moderate_disagreement' ELSE 'other' END AS slice FROM obs WHERE value IS NOT NULL),
summary AS (SELECT method, round(avg(value), 3) AS event_nll, round(avg(value * value), 1) AS degree_nll FROM m GROUP BY method),
slices AS (SELECT method, slice, round(avg(CASE WHEN value < 50 THEN 1.0::DOUBLE ELSE 0 END), 4) AS observed_probability, round(avg(abs(value - 50)), 3) AS q50_mae FROM (SELECT * FROM m WHERE slice <> 'other' UNION ALL SELECT method, value, 'overall' FROM m) GROUP BY ALL)"""


def _promotion_sql(broken: str) -> str:
    return f"""WITH {_methods}, against AS (SELECT a.method, bool_or({broken}) AS bad FROM slices a JOIN slices b ON b.method = 'view' AND a.slice = b.slice WHERE a.method <> 'view' GROUP BY a.method),
placed AS (SELECT summary.method, coalesce(bad, false) AS bad, row_number() OVER (ORDER BY event_nll, degree_nll, summary.method) AS place FROM summary LEFT JOIN against USING (method)), chosen AS (SELECT min(place) AS place FROM placed WHERE NOT bad)
SELECT method, (SELECT count(*) FROM placed, chosen WHERE placed.bad AND placed.place < chosen.place) AS rejected FROM placed JOIN chosen USING (place)"""


def _summary(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = observations(spark, sf_dir).where("value IS NOT NULL").select(F.col("event_type").alias("method"), "value", F.when(F.col("k") % 4 == 0, "tight_consensus").when(F.col("k") % 4 == 1, "moderate_disagreement").alias("slice"))
    summary = rows.groupBy("method").agg(F.round(F.avg("value"), 3).alias("event_nll"), F.round(F.avg(F.col("value") * F.col("value")), 1).alias("degree_nll"))
    sliced = rows.where("slice IS NOT NULL").unionByName(rows.withColumn("slice", F.lit("overall"))).groupBy("method", "slice")
    return summary, sliced.agg(F.round(F.avg((F.col("value") < 50).cast("double")), 4).alias("observed_probability"), F.round(F.avg(F.abs(F.col("value") - 50)), 3).alias("q50_mae"))


_drop = "b.observed_probability - a.observed_probability > 0.02"


@query(_promotion_sql(f"{_drop} AND (a.slice IN ('tight_consensus', 'moderate_disagreement') OR a.slice = 'overall' AND b.q50_mae - a.q50_mae < 0.05)"))
def calibration_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best method that loses no more than 0.02 where the sources agree, nor over all rows unless its median makes that good."""
    return select.promoted(*_summary(spark, sf_dir), "method", "view", ["event_nll", "degree_nll"], ("tight_consensus", "moderate_disagreement"), "observed_probability", 0.02, "q50_mae", 0.05)


@query(_promotion_sql(_drop))
def ladder_promotion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same for ladders, where a drop over all rows counts whatever else gains."""
    return select.promoted(*_summary(spark, sf_dir), "method", "view", ["event_nll", "degree_nll"], ("tight_consensus", "moderate_disagreement", "overall"), "observed_probability", 0.02)


# --- scores ------------------------------------------------------------------------

_pit = "pit_low + 0.5 * observed_probability"


@query(f"""WITH {SCORES}, p AS (SELECT *, {_pit} AS pit, month({_day}) AS m, station % 7 AS d FROM scores), e AS (SELECT *, unnest(list_filter(['overall', CASE WHEN m BETWEEN 4 AND 10 THEN 'warm_apr_oct' ELSE 'cool_nov_mar' END, CASE WHEN d < 2 THEN 'lt_2f' WHEN d < 5 THEN '2_to_5f' ELSE 'gte_5f' END], lambda x: x IS NOT NULL)) AS slice FROM p)
SELECT slice, count(*) AS row_count, round(avg(pit), 6) AS pit_mean, round(stddev_pop(pit), 6) AS pit_std, round(avg(CASE WHEN pit < 0.1 THEN 1.0 ELSE 0 END), 6) AS pit_below_0_1, round(avg(CASE WHEN pit > 0.9 THEN 1.0 ELSE 0 END), 6) AS pit_above_0_9 FROM e GROUP BY slice""")
def pit_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    m, d = F.month(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("station") % 366).cast("int"))), F.col("station") % 7
    slices = {"warm_apr_oct": m.between(4, 10), "cool_nov_mar": ~m.between(4, 10), "lt_2f": d < 2, "2_to_5f": (d >= 2) & (d < 5), "gte_5f": d >= 5}
    found = scoring.pit_slices(scored(spark, sf_dir), "pit_mid", slices)
    return found.select("slice", "row_count", *[c.alias(n) for n, c in rounded("pit_mean", "pit_std", "pit_below_0_1", "pit_above_0_9").items()])


_common = LADDER.replace("CAST(floor(q05) AS INTEGER) - 8 AS low, CAST(ceil(q95) AS INTEGER) + 8 AS high FROM pred)", "(SELECT CAST(floor(least(min(q05), min(y)) - 8) AS INTEGER) FROM pred) AS low, (SELECT CAST(ceil(greatest(max(q95), max(y)) + 8) AS INTEGER) FROM pred) AS high FROM pred)")


@query(f"""WITH {_common}, c AS (SELECT *, sum(probability) OVER (PARTITION BY station, event_type ORDER BY temp_f) AS cdf FROM ladder)
SELECT station, event_type, count(*) AS degrees, min(temp_f) AS low, max(temp_f) AS high, round(avg((cdf - CASE WHEN temp_f >= observed_f THEN 1 ELSE 0 END) ** 2), 6) AS rps FROM c GROUP BY station, event_type""")
def common_bounds_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ladders over the same degrees for all predictions, as the mean over degrees of the ranked score needs."""
    pred = ladder.common_bounds(predictions(spark, sf_dir), ENDS, observed="y")
    rows = ladder.interpolated_ladder(pred, [*KEY, "observed_f"])
    ends = rows.groupBy(*KEY).agg(F.count("*").alias("degrees"), F.min("temp_f").alias("low"), F.max("temp_f").alias("high"))
    return scoring.ladder_scores(rows, KEY, "observed_f").join(ends, KEY).select(*KEY, "degrees", "low", "high", F.round("rps", 6).alias("rps"))


# --- least squares -----------------------------------------------------------------


def _gauss(terms: list[str], y: str, source: str, ridge: float = 0.0, by: str = "") -> str:
    """CTEs that solve the normal equations of y on an intercept and ``terms`` by elimination: c0, c1, ... in solved."""
    x = ["1.0::DOUBLE", *terms]
    n = len(x)
    group = f"{by}, " if by else ""
    sums = [f"sum({x[i]} * {x[j]}) + {ridge if i == j and i else 0.0} AS a{i}_{j}" for i in range(n) for j in range(n)] + [f"sum({x[i]} * {y}) AS a{i}_{n}" for i in range(n)]
    whole = " AND ".join(f"{t} IS NOT NULL" for t in (*terms, y))
    out = [f"m0 AS (SELECT {group}count(*) AS n_rows, {', '.join(sums)} FROM {source} WHERE {whole}{f' GROUP BY {by}' if by else ''})"]
    for k in range(n):
        step = [f"a{i}_{j} {f'- a{i}_{k} / a{k}_{k} * a{k}_{j}' if i != k else f'/ a{k}_{k}'} AS a{i}_{j}" for i in range(n) for j in range(n + 1)]
        out.append(f"m{k + 1} AS (SELECT {group}n_rows, {', '.join(step)} FROM m{k})")
    return ", ".join([*out, f"solved AS (SELECT {group}n_rows, {', '.join(f'a{i}_{n} AS c{i}' for i in range(n))} FROM m{n})"])


def _blend(spark: SparkSession, sf_dir: str, terms: list[str]) -> DataFrame:
    rows = frame(spark, sf_dir)
    c = linreg.fit(rows, "y", terms)
    return rows.select("station", "date_local", F.round(linreg.predict(terms, c), 4).alias("blend_f"))


@query(f"WITH {FRAME}, {_gauss(['nbm', 'lamp'], 'y', 'frame')} SELECT station, date_local, round(c0 + c1 * nbm + c2 * lamp, 4) AS blend_f FROM frame, solved")
def two_way_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blend(spark, sf_dir, ["nbm", "lamp"])


@query(f"WITH {FRAME}, {_gauss(['nbm', 'lamp', 'hrrr'], 'y', 'frame')} SELECT station, date_local, round(c0 + c1 * nbm + c2 * lamp + c3 * hrrr, 4) AS blend_f FROM frame, solved")
def three_way_blend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _blend(spark, sf_dir, ["nbm", "lamp", "hrrr"])


@query(f"WITH {FRAME}, {_gauss(['nbm', 'lamp', 'hrrr', 'native'], 'y', 'frame', 1.0)} SELECT station, date_local, round(c0 + c1 * nbm + c2 * lamp + c3 * hrrr + c4 * native, 4) AS anchor_f, y FROM frame, solved")
def ridge_anchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir)
    terms = ["nbm", "lamp", "hrrr", "native"]
    return rows.select("station", "date_local", F.round(linreg.predict(terms, linreg.fit(rows, "y", terms, ridge=1.0)), 4).alias("anchor_f"), "y")


_folded = f"f AS (SELECT fold, CASE WHEN date_local <= train_end THEN 'train' ELSE 'validation' END AS part, station, nbm, lamp, hrrr, y FROM frame, {_origins} WHERE date_local <= train_end OR date_local BETWEEN valid_start AND valid_end)"
SPECS = {"mean": ("nbm", "lamp"), "two": ("nbm", "lamp"), "three": ("nbm", "lamp", "hrrr")}


def _specs_sql() -> str:
    parts = [f"SELECT fold, 'mean' AS candidate, count(*) AS n, avg(abs((nbm + lamp) / 2 - y)) AS mae FROM f WHERE part = 'validation' AND nbm IS NOT NULL AND lamp IS NOT NULL AND y IS NOT NULL GROUP BY fold"]
    for name, terms in list(SPECS.items())[1:]:
        whole = " AND ".join(f"f.{t} IS NOT NULL" for t in (*terms, "y"))
        guess = "s.c0 + " + " + ".join(f"s.c{k} * f.{t}" for k, t in enumerate(terms, 1))
        solved = _gauss(list(terms), "y", "(SELECT * FROM f WHERE part = 'train')", 1.0, "fold")
        parts.append(f"SELECT * FROM (WITH {solved} SELECT f.fold, '{name}' AS candidate, count(*) AS n, avg(abs({guess} - f.y)) AS mae FROM f JOIN solved s ON s.fold = f.fold WHERE part = 'validation' AND {whole} GROUP BY f.fold)")
    return f"WITH {FRAME}, {_folded}, r AS ({' UNION ALL '.join(parts)}) SELECT CAST(fold AS BIGINT) AS fold, candidate, n, round(mae, 4) AS mae FROM r"


@query(_specs_sql())
def fold_candidate_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate trained and scored in every fold: one aggregate of sums by fold for each, and one pass that scores them all."""
    rows = folds.rolling_origin(frame(spark, sf_dir), "date_local", ORIGINS)
    guesses = []
    for name, terms in SPECS.items():
        whole = F.lit(True)
        for t in (*terms, "y"):
            whole = whole & F.col(t).isNotNull()
        if name == "mean":
            guess: Column = (F.col("nbm") + F.col("lamp")) / 2
        else:
            fitted = linreg.fit_groups(rows.where("part = 'train'"), "y", terms, "fold", ridge=1.0)
            guess = F.coalesce(*[F.when(F.col("fold") == fold, linreg.predict(terms, c)) for fold, c in fitted.items()], F.lit(None).cast("double"))
        guesses.append(F.struct(F.lit(name).alias("candidate"), F.when(whole, F.abs(guess - F.col("y"))).alias("e")))
    long = rows.where("part = 'validation'").select("fold", F.explode(F.array(*guesses)).alias("g")).select("fold", "g.*").where("e IS NOT NULL")
    return long.groupBy("fold", "candidate").agg(F.count("*").alias("n"), F.round(F.avg("e"), 4).alias("mae"))


# --- joins of scores and summaries ---------------------------------------------------


@query(f"""WITH {REGIME}, a AS (SELECT station, date_local, abs(nbm - y) AS with_error FROM reg WHERE nbm IS NOT NULL AND y IS NOT NULL), b AS (SELECT station, date_local, abs(lamp - y) AS without_error FROM reg WHERE lamp IS NOT NULL AND y IS NOT NULL)
SELECT a.station, a.date_local, round(with_error, 6) AS with_error, round(without_error, 6) AS without_error, reg.regime, round(reg.hrrr, 6) AS hrrr FROM a JOIN b USING (station, date_local) LEFT JOIN reg USING (station, date_local)""")
def score_tables_joined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two score tables on their common keys, with what was predicted beside them where there is any."""
    rows = regimes(spark, sf_dir)
    key = ["station", "date_local"]

    def errors(source: str, name: str) -> DataFrame:
        return rows.where(F.col(source).isNotNull() & F.col("y").isNotNull()).select(*key, F.abs(F.col(source) - F.col("y")).alias(name))

    both = errors("nbm", "with_error").join(errors("lamp", "without_error"), key).join(rows.select(*key, "regime", "hrrr"), key, "left")
    return both.select(*key, *[F.round(c, 6).alias(c) for c in ("with_error", "without_error")], "regime", F.round("hrrr", 6).alias("hrrr"))


@query(f"""WITH {CANDIDATES}, s AS (SELECT candidate, sum(mae * n) / sum(n) AS mae FROM folds GROUP BY candidate), x AS (SELECT * FROM (VALUES ('nbm', 3), ('half', 1), ('unknown', 9)) v(candidate, crossings))
SELECT x.candidate, CAST(crossings AS BIGINT) AS crossings, round(mae, 6) AS mae, round(mae + 0.1 * crossings, 6) AS penalised FROM x LEFT JOIN s USING (candidate)""")
def crossing_penalty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates with their crossings, beside the selection table where it has them: loss plus a penalty for each crossing."""
    found = candidate_folds(spark, sf_dir).groupBy("candidate").agg((F.sum(F.col("mae") * F.col("n")) / F.sum("n")).alias("mae"))
    crossed = spark.createDataFrame([("nbm", 3), ("half", 1), ("unknown", 9)], "candidate string, crossings long")
    return crossed.join(F.broadcast(found), "candidate", "left").select("candidate", "crossings", F.round("mae", 6).alias("mae"), F.round(F.col("mae") + 0.1 * F.col("crossings"), 6).alias("penalised"))


@query(f"""WITH {CANDIDATES}, s AS (SELECT candidate, row_number() OVER (ORDER BY sum(mae * n) / sum(n), candidate) AS place, count(*) OVER () AS total FROM folds GROUP BY candidate)
SELECT CAST(size AS INTEGER) AS size, candidate, CAST(place AS INTEGER) AS place FROM s, (VALUES (2), (3), (5)) v(size) WHERE size <= total AND place <= size""")
def top_ensemble_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = candidate_folds(spark, sf_dir).groupBy("candidate").agg((F.sum(F.col("mae") * F.col("n")) / F.sum("n")).alias("loss"))
    return select.top_members(found, ["loss"], "candidate")


@query(f"""WITH {REGIME} SELECT station, date_local, CASE regime WHEN 'unknown' THEN 'a source is missing' WHEN 'native_warm_hrrr_cold' THEN 'native is ' || format('{{:.1f}}', round(native - hrrr + 1e-9, 1)) || ' above hrrr' WHEN 'native_cold_hrrr_warm' THEN 'hrrr is ' || format('{{:.1f}}', round(hrrr - native + 1e-9, 1)) || ' above native'
    WHEN 'hrrr_hot_outlier' THEN 'hrrr is ' || format('{{:.1f}}', round(hrrr - greatest(nbm, native, lamp) + 1e-9, 1)) || ' above all others' WHEN 'hrrr_cold_outlier' THEN 'hrrr is ' || format('{{:.1f}}', round(least(nbm, native, lamp) - hrrr + 1e-9, 1)) || ' below all others'
    ELSE 'sources spread over ' || format('{{:.1f}}', round(spread + 1e-9, 1)) END AS reason FROM reg""")
def regime_reason(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why a row has its regime, in words."""
    from isobar.functions import encode

    return regimes(spark, sf_dir).select("station", "date_local", encode.reason(F.col("regime"), *[F.col(s) for s in ("nbm", "native", "lamp", "hrrr")]).alias("reason"))


# --- payloads, logs, gates ---------------------------------------------------------


@query(f"WITH {PRED} SELECT station, event_type, round(q05 + 1e-9, 4) AS q05, round(q50 + 1e-9, 4) AS q50, round(q95 + 1e-9, 4) AS q95 FROM pred")
def prediction_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions as JSON payloads, read back from their text."""
    rows = predictions(spark, sf_dir).withColumns({t: F.col(t) + 1e-9 for t in TAGS}).select(folds.payload(KEY, TAGS).alias("payload"))
    read = F.from_json("payload", "station long, event_type string, quantiles struct<q05:double,q50:double,q95:double>")
    return rows.select(read.alias("p")).select("p.station", "p.event_type", "p.quantiles.*")


@query(f"""WITH {OBS}, e AS (SELECT station, ts, event_id, date_local, event_type, CASE WHEN lag(date_local) OVER w IS DISTINCT FROM date_local THEN 1 ELSE 0 END AS fresh, value FROM obs WINDOW w AS (PARTITION BY station ORDER BY ts, event_id)),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY station ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS generation FROM e)
SELECT station, generation, any_value(date_local) AS date_local, count(*) AS entries, max(value) AS max_so_far, arg_max(event_type, (ts, event_id)) AS last_type FROM s GROUP BY station, generation QUALIFY row_number() OVER (PARTITION BY station ORDER BY generation DESC) = 1""")
def audit_log_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The state that an append-only log gives when it is read again: of each station since its day last changed."""
    from isobar.session import scratch_path
    from isobar.sources import sinks

    log = scratch_path(spark, "audit-log")
    rows = observations(spark, sf_dir).select("station", "ts", "event_id", "date_local", "event_type", "value")
    for part in (rows.where("event_id % 2 = 0"), rows.where("event_id % 2 = 1")):
        sinks.append_log(part, log)
    return sinks.reloaded_state(sinks.read_log(spark, log, rows.schema), ["station"], "date_local", ["ts", "event_id"], {"max_so_far": F.max("value"), "last_type": F.max_by("event_type", F.struct("ts", "event_id"))})


@query(f"""WITH {OBS} SELECT date_local, CAST(count(DISTINCT hour_local) AS BIGINT) AS slots, count(DISTINCT hour_local) >= 22 AS complete, count(*) AS n FROM obs WHERE hour_local <= 21 GROUP BY date_local""")
def day_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days whose hours 0 to 21 are all there may be finalised."""
    from isobar.sources import sinks

    return sinks.complete_days(observations(spark, sf_dir).where("hour_local <= 21"), ["date_local"], "hour_local", 22).select("date_local", "slots", "complete", "n")


@query("""SELECT s_nationkey AS nation, round(avg(s_acctbal), 6) AS mean_balance, count(*) AS n FROM supplier GROUP BY 1""")
def csv_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics written as one CSV file with a header, and read again."""
    from isobar.session import scratch_path
    from isobar.sources import sinks

    at = scratch_path(spark, "metrics")
    rows = table(spark, sf_dir, "supplier").groupBy(F.col("s_nationkey").alias("nation")).agg(F.round(F.avg("s_acctbal"), 6).alias("mean_balance"), F.count("*").alias("n"))
    sinks.write_metrics(rows, at)
    return spark.read.schema(rows.schema).option("header", True).csv(at)
