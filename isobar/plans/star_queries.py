"""The overnight table: one row a day and station, as known at 00:05 local time; its normal form and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions import encode
from isobar.functions.units import TRANSFORMS
from isobar.operators import asof, boosting, quantile_gbm
from isobar.operators.order_stats import quantiles
from isobar.operators.ladder import LEVELS, rearranged, tag
from isobar.plans import contracts
from isobar.plans.contracts import column
from isobar.plans.forecast_queries import frame, regimes
from isobar.plans.observation_queries import DAY, spine
from isobar.plans.registry import OBS, SPINE, observations, query, table
from isobar.session import scratch_path

STAR = contracts.registry(
    column("date_local", "date", "identity"), column("station", "int64", "identity"), column("station_name", "string", "identity", "optional_candidate"), column("station_region", "string", "identity", "optional_candidate"),
    column("label_tmax_f", "float64", "label"), column("label_tmin_f", "float64", "label"), column("label_market_bin", "string", "label"), column("wu_prev_tmax_f", "float64", "feature", "optional_candidate"),
    column("wu_obs_available", "bool", "feature"), column("wu_last_f", "float64", "feature", "optional_candidate"), column("wu_change_1h_f", "float64", "feature", "optional_candidate"), column("wu_change_3h_f", "float64", "feature", "optional_candidate"), column("wu_change_6h_f", "float64", "feature", "optional_candidate"),
    column("nbm_available", "bool", "feature"), column("nbm_tmax_f", "float64", "feature", "optional_candidate"), column("lamp_available", "bool", "feature"), column("lamp_tmax_f", "float64", "feature", "optional_candidate"),
    column("hrrr_available", "bool", "feature"), column("hrrr_wind_ms", "float64", "feature", "optional_candidate"), column("nbm_minus_lamp_tmax_f", "float64", "feature", "optional_candidate"), column("anchor_tmax_f", "float64", "feature", "optional_candidate"), column("target_residual_f", "float64", "label", "optional_candidate"),
)


def star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with what each source had by the cutoff; a missing source leaves its columns null and its flag false.

    Sources of one grain are one conditional aggregate with the labels; only
    those of another grain are joined.
    """
    obs = observations(spark, sf_dir)

    def mean(kind: str) -> Column:
        return F.avg(F.when(F.col("event_type") == kind, F.col("value")))

    error = F.when(F.col("event_type") == "error", F.col("value"))
    days = obs.groupBy(*DAY).agg(F.max("value").alias("label_tmax_f"), F.min("value").alias("label_tmin_f"), mean("click").alias("nbm_tmax_f"), mean("purchase").alias("lamp_tmax_f"), F.sum(error).alias("__sum"), F.count(error).alias("__n"))
    # A row a day and station: written once, as four parts of the table start from it and not from the observations.
    at = scratch_path(spark, "days")
    days.write.parquet(at)
    days = spark.read.schema(days.schema).parquet(at)
    hrrr = days.groupBy("date_local").agg((F.sum("__sum") / F.sum("__n")).alias("hrrr_wind_ms"))
    own = [F.col(c).alias(c) for c in ("label_tmax_f", "label_tmin_f", "nbm_tmax_f", "lamp_tmax_f")]
    # A day's label is sent to its own row and to the next day's.
    none = [F.lit(None).cast("double").alias(c) for c in ("label_tmax_f", "label_tmin_f", "nbm_tmax_f", "lamp_tmax_f")]
    both = F.array(F.struct(F.col("date_local").alias("date_local"), F.lit(True).alias("own"), *own, F.lit(None).cast("double").alias("wu_prev_tmax_f")), F.struct(F.date_add("date_local", 1).alias("date_local"), F.lit(False).alias("own"), *none, F.col("label_tmax_f").alias("wu_prev_tmax_f")))
    sent = days.select("station", F.explode(both).alias("d")).select("station", "d.*")
    labels = sent.groupBy(*DAY).agg(F.bool_or("own").alias("own"), *[F.max(c).alias(c) for c in ("label_tmax_f", "label_tmin_f", "nbm_tmax_f", "lamp_tmax_f", "wu_prev_tmax_f")]).where("own").drop("own")
    labels = labels.withColumn("label_market_bin", F.concat(F.bround("label_tmax_f", 0).cast("long").cast("string"), F.lit("F")))
    seen = asof.cutoff_snapshot(obs.select("station", "ts", "value", "event_id"), spine(days), ["station"], "ts", "cutoff", "value", tie=["event_id"]).select(
        *DAY, F.col("last_matched_at").isNotNull().alias("wu_obs_available"), F.col("last_value").alias("wu_last_f"), *[F.col(f"change_{h}h").alias(f"wu_change_{h}h_f") for h in (1, 3, 6)]
    )
    joined = labels.join(seen, DAY, "left").join(hrrr, "date_local", "left")
    customer, nation, region = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    places = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"]).join(region, nation["n_regionkey"] == region["r_regionkey"]).select(F.col("c_custkey").alias("station"), F.col("c_name").alias("station_name"), F.col("r_name").alias("station_region"))
    joined = joined.join(places, "station", "left")
    nbm, lamp = F.col("nbm_tmax_f"), F.col("lamp_tmax_f")
    anchor = 0.5 * nbm + 0.5 * lamp
    return contracts.layout(joined.withColumns({
        "nbm_available": nbm.isNotNull(), "lamp_available": lamp.isNotNull(), "hrrr_available": F.col("hrrr_wind_ms").isNotNull(), "nbm_minus_lamp_tmax_f": nbm - lamp, "anchor_tmax_f": anchor, "target_residual_f": F.col("label_tmax_f") - anchor,
    }), STAR)


_doubles = [f.name for f in STAR if f.dataType.typeName() == "double"]
STAR_SQL = f"""{OBS}, {SPINE},
days AS (SELECT station, date_local, max(value) AS label_tmax_f, min(value) AS label_tmin_f FROM obs GROUP BY ALL),
seen AS (SELECT s.station, s.date_local, l.ts IS NOT NULL AS wu_obs_available, l.value AS wu_last_f, l.value - h1.value AS wu_change_1h_f, l.value - h3.value AS wu_change_3h_f, l.value - h6.value AS wu_change_6h_f
    FROM spine s ASOF LEFT JOIN obs l ON s.station = l.station AND s.cutoff >= l.ts {" ".join(f"ASOF LEFT JOIN obs h{h} ON s.station = h{h}.station AND s.cutoff - INTERVAL {h} HOUR >= h{h}.ts" for h in (1, 3, 6))}),
nbm AS (SELECT station, date_local, avg(value) AS v FROM obs WHERE event_type = 'click' GROUP BY ALL), lamp AS (SELECT station, date_local, avg(value) AS v FROM obs WHERE event_type = 'purchase' GROUP BY ALL),
hrrr AS (SELECT date_local, avg(value) AS v FROM obs WHERE event_type = 'error' GROUP BY ALL),
star AS (SELECT d.date_local, d.station, c.c_name AS station_name, r.r_name AS station_region, d.label_tmax_f, d.label_tmin_f, CAST(CAST(round_even(d.label_tmax_f, 0) AS BIGINT) AS VARCHAR) || 'F' AS label_market_bin, p.label_tmax_f AS wu_prev_tmax_f,
    s.wu_obs_available, s.wu_last_f, s.wu_change_1h_f, s.wu_change_3h_f, s.wu_change_6h_f, n.v IS NOT NULL AS nbm_available, n.v AS nbm_tmax_f, l.v IS NOT NULL AS lamp_available, l.v AS lamp_tmax_f, h.v IS NOT NULL AS hrrr_available, h.v AS hrrr_wind_ms,
    n.v - l.v AS nbm_minus_lamp_tmax_f, 0.5 * n.v + 0.5 * l.v AS anchor_tmax_f, d.label_tmax_f - (0.5 * n.v + 0.5 * l.v) AS target_residual_f
    FROM days d LEFT JOIN days p ON p.station = d.station AND p.date_local = d.date_local - 1 LEFT JOIN seen s ON s.station = d.station AND s.date_local = d.date_local LEFT JOIN nbm n ON n.station = d.station AND n.date_local = d.date_local
    LEFT JOIN lamp l ON l.station = d.station AND l.date_local = d.date_local LEFT JOIN hrrr h ON h.date_local = d.date_local LEFT JOIN customer c ON c.c_custkey = d.station LEFT JOIN nation na ON na.n_nationkey = c.c_nationkey LEFT JOIN region r ON r.r_regionkey = na.n_regionkey)"""


@query(f"WITH {STAR_SQL} SELECT * REPLACE ({', '.join(f'round({c} + 1e-9, 6) AS {c}' for c in _doubles)}) FROM star")
def overnight_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star(spark, sf_dir).withColumns({c: F.round(F.col(c) + 1e-9, 6) for c in _doubles})


@query(f"""WITH {STAR_SQL} SELECT date_local, station, round(label_tmax_f + 1e-9, 6) AS label_tmax_f, round(hrrr_wind_ms * 2.2369362920544 + 1e-9, 6) AS hrrr_wind_mph, round(anchor_tmax_f + 1e-9, 6) AS anchor_tmax_f,
    CASE WHEN nbm_minus_lamp_tmax_f IS NULL THEN 'unknown' WHEN abs(nbm_minus_lamp_tmax_f) < 2 THEN 'lt_2f' WHEN abs(nbm_minus_lamp_tmax_f) < 5 THEN '2f_to_5f' ELSE '5f_or_more' END AS disagreement,
    CASE station_region WHEN 'AFRICA' THEN 0 WHEN 'AMERICA' THEN 1 WHEN 'ASIA' THEN 2 WHEN 'EUROPE' THEN 3 ELSE -1 END AS region_id FROM star""")
def normalized_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star(spark, sf_dir)
    converted = rows.select(*[TRANSFORMS[t](F.col(source)).alias(name) for source, t, name in contracts.normalised_registry(STAR)])
    encoded = encode.learned_ids(converted.withColumn("disagreement", encode.disagreement_bucket(F.col("nbm_minus_lamp_tmax_f"), "unknown")), "station_region", "region_id", ["AFRICA", "AMERICA", "ASIA", "EUROPE"])
    return encoded.select("date_local", "station", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("label_tmax_f", "hrrr_wind_mph", "anchor_tmax_f")], "disagreement", F.col("region_id").cast("int").alias("region_id"))


@query(f"""WITH {STAR_SQL} SELECT count(*) AS row_count, CAST(sum((date_local IS NULL)::INT + (station IS NULL)::INT + (label_tmax_f IS NULL)::INT + (label_tmin_f IS NULL)::INT + (label_market_bin IS NULL)::INT) AS BIGINT) AS core_nulls,
    (SELECT count(*) FROM (SELECT 1 FROM star GROUP BY date_local, station HAVING count(*) > 1)) AS duplicate_keys, true AS exact_layout, 0::BIGINT AS missing_columns, 0::BIGINT AS unknown_columns, 0::BIGINT AS prefix_violations, 0::BIGINT AS string_inputs, true AS passed,
    count(*) FILTER (abs(target_residual_f - (label_tmax_f - anchor_tmax_f)) > 1e-6) AS residual_violations FROM star""")
def contract_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = star(spark, sf_dir)
    off = F.abs(F.col("target_residual_f") - (F.col("label_tmax_f") - F.col("anchor_tmax_f"))) > 1e-6
    return contracts.audit(rows, STAR, ["date_local", "station"], violations={"residual_violations": off})


_profiled = ("text", "lang", "source", "n_chars", "quality", "toxic")


@query(" UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) AS n, round(avg(CASE WHEN {c} IS NULL THEN 1.0 ELSE 0 END) + 1e-9, 6) AS null_rate, {f'round(var_samp({c}) + 1e-7, 4)' if c in ('n_chars', 'quality', 'toxic') else 'NULL::DOUBLE'} AS variance FROM documents LEFT JOIN labels USING (doc_id)" for c in _profiled))
def null_rate_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    return contracts.profile(rows, _profiled).select("column", "n", F.round(F.col("null_rate") + 1e-9, 6).alias("null_rate"), F.round(F.col("variance") + 1e-7, 4).alias("variance"))


@query()
def quantile_gbm_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows-only: another learner than the one it stands for, so tests hold it to invariants and to its gain over the anchor."""
    rows = frame(spark, sf_dir)
    model = quantile_gbm.fit(rows, "y", ["nbm", "native", "lamp", "hrrr"], rounds=3, depth=3)
    tags = [tag(q) for q in LEVELS]
    raw = rows.select("station", "date_local", "y", *[model.predict(q).alias(t) for q, t in zip(LEVELS, tags, strict=True)])
    return raw.select("station", "date_local", "y", *rearranged(tags))


@query()
def weighted_mean_gbm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows-only, as above: the mean boosted over the sources with regime weights, and a second model for what the first leaves."""
    rows = regimes(spark, sf_dir)
    sources = ["nbm", "native", "lamp", "hrrr"]
    direct = boosting.fit(rows, "y", sources, bins=8, weight=encode.regime_weight(F.col("regime")))
    scored = rows.withColumn("direct_f", direct.predict()).withColumn("left_f", F.col("y") - F.col("direct_f"))
    meta = boosting.fit(scored, "left_f", ["direct_f", "spread"], rounds=20, bins=8)
    return scored.select("station", "date_local", "y", "direct_f", (F.col("direct_f") + meta.predict()).alias("corrected_f"))


@query(f"""WITH {OBS} SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.95), 6) AS p95, min(value) AS least, max(value) AS most FROM obs GROUP BY event_type""")
def diagnostics_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quantiles(observations(spark, sf_dir), ["event_type"], {"q": F.col("value")}, {"q": (0.5, 0.95)}, [F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most")])
    return found.select("event_type", "n", F.round(F.col("q")[0], 6).alias("median"), F.round(F.col("q")[1], 6).alias("p95"), "least", "most")


@query(f"""WITH {OBS} SELECT station, arg_max(event_type, (ts, event_id)) AS status, CAST(count(*) AS BIGINT) AS n_events, count(*) FILTER (event_type = 'error') AS n_failed FROM obs GROUP BY station""")
def status_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("station").agg(F.max_by("event_type", F.struct("ts", "event_id")).alias("status"), F.count("*").alias("n_events"), F.count_if(F.col("event_type") == "error").alias("n_failed"))


@query(f"""WITH {OBS}, i AS (SELECT date_local, max(ts) AS changed_at FROM obs WHERE event_type = 'click' GROUP BY ALL), o AS (SELECT date_local, max(ts) AS built_at, CASE WHEN count(*) % 5 = 0 THEN 'failed' ELSE 'ok' END AS status FROM obs WHERE event_type = 'view' GROUP BY ALL)
SELECT i.date_local FROM i LEFT JOIN o USING (date_local) WHERE o.built_at IS NULL OR o.status <> 'ok' OR o.built_at < i.changed_at""")
def incremental_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isobar.sources.sinks import stale_partitions

    obs = observations(spark, sf_dir)
    inputs = obs.where("event_type = 'click'").select("date_local", F.col("ts").alias("changed_at"))
    outputs = obs.where("event_type = 'view'").groupBy("date_local").agg(F.max("ts").alias("built_at"), F.when(F.count("*") % 5 == 0, "failed").otherwise("ok").alias("status"))
    return stale_partitions(outputs, inputs, ["date_local"])


_codes = ["C", "bk", "OVC", "few", "", "??", "sct", "clear", "VV"]


@query(f"""WITH {OBS}, t AS (SELECT event_id, list_extract({_codes}, CAST(k % 9 + 1 AS INTEGER)) AS token FROM obs)
SELECT event_id, CASE token WHEN 'C' THEN 2 WHEN 'clear' THEN 2 WHEN 'bk' THEN 6 WHEN 'OVC' THEN 7 WHEN 'few' THEN 4 WHEN '' THEN 0 WHEN '??' THEN 1 WHEN 'sct' THEN 5 WHEN 'VV' THEN 8 END AS cloud_id FROM t""")
def vocabulary_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    token = F.element_at(F.array(*map(F.lit, _codes)), (F.col("k") % 9 + 1).cast("int"))
    return observations(spark, sf_dir).select("event_id", encode.vocabulary_id(encode.cloud_token(token), encode.VOCABULARIES["cloud_cover"]).alias("cloud_id"))


@query("""SELECT event_id, round((value - 273.15) * 9 / 5 + 32 + 1e-9, 6) AS k_to_f, round(value * 2.2369362920544 + 1e-9, 6) AS ms_to_mph, round(value * 1.150779448 + 1e-9, 6) AS kt_to_mph, round(value / 1609.344 + 1e-9, 6) AS m_to_mi, round(value * 3.2808398950131 + 1e-9, 6) AS m_to_ft, round(value / 25.4 + 1e-9, 6) AS kg_m2_to_in,
    round(sqrt(value * value + 25) + 1e-9, 6) AS wind_speed, round(((270 - degrees(atan2(5, value))) % 360 + 360) % 360 + 1e-9, 6) AS wind_direction FROM events""")
def unit_conversions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isobar.functions.units import wind_direction, wind_speed

    v = F.col("value")
    named = {n: TRANSFORMS[n](v) for n in ("k_to_f", "ms_to_mph", "kt_to_mph", "m_to_mi", "m_to_ft", "kg_m2_to_in")} | {"wind_speed": wind_speed(v, F.lit(5.0)), "wind_direction": wind_direction(v, F.lit(5.0))}
    return table(spark, sf_dir, "events").select("event_id", *[F.round(c + 1e-9, 6).alias(n) for n, c in named.items()])


def _cells(rows: range, cols: range) -> str:
    return "[" + ", ".join(f"embedding[{r * 8 + c + 1}]::DOUBLE" for r in rows for c in cols) + "]"


def _stencil_sql(r: int, c: int, radius: int) -> str:
    rows, cols = range(max(0, r - radius), min(8, r + radius + 1)), range(max(0, c - radius), min(8, c + radius + 1))
    w = _cells(rows, cols)
    return f"""SELECT vec_id, round(list_avg({w}), 5) AS mean, round(list_min({w}), 5) AS min, round(list_max({w}), 5) AS max, round(list_stddev_pop({w}), 5) AS std,
    round(list_avg({_cells(rows, cols[-1:])}) - list_avg({_cells(rows, cols[:1])}), 5) AS west_east, round(list_avg({_cells(rows[:1], cols)}) - list_avg({_cells(rows[-1:], cols)}), 5) AS south_north FROM embeddings"""


def _stencil(spark: SparkSession, sf_dir: str, r: int, c: int, radius: int) -> DataFrame:
    from isobar.operators.stencil import array_window

    return table(spark, sf_dir, "embeddings").select("vec_id", *[F.round(x, 5).alias(n) for n, x in array_window(F.col("embedding"), 8, 8, r, c, radius).items()])


@query(_stencil_sql(3, 4, 1))
def embedding_stencil_3x3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stencil(spark, sf_dir, 3, 4, 1)


@query(_stencil_sql(1, 6, 3))
def embedding_stencil_clipped_7x7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stencil(spark, sf_dir, 1, 6, 3)


@query("""WITH c AS (SELECT conv_id, turn, role, length(text) AS n FROM conversations) SELECT conv_id, count(*) AS turns, CAST(sum(n) AS BIGINT) AS chars, arg_max(role, turn) AS last_role, bool_and(turn >= 0) AS ordered FROM c GROUP BY conv_id""")
def conversation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count("*").alias("turns"), F.sum(F.length("text")).cast("long").alias("chars"), F.max_by("role", "turn").alias("last_role"), F.bool_and(F.col("turn") >= 0).alias("ordered"))
