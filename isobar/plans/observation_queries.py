"""Station observations: labels, as-of features, checkpoints, spines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.functions.timeops import cutoff, day_angle, micros, season
from isobar.operators import asof, summarize
from isobar.plans.registry import OBS, SPINE, observations, query, rounded, table

DAY = ["station", "date_local"]


def spine(obs: DataFrame) -> DataFrame:
    return obs.select(*DAY).distinct().withColumn("cutoff", cutoff(F.col("date_local")))


@query(f"""WITH {OBS}
SELECT station, date_local, round(max(value), 6) AS final_tmax, round(min(value), 6) AS final_tmin, CAST(sum(coalesce(k, 0)) AS BIGINT) AS total_precip,
    count(*) AS obs_count, epoch_us(min(ts)) AS first_obs_us, epoch_us(max(ts)) AS last_obs_us, CAST(CAST(round_even(max(value), 0) AS BIGINT) AS VARCHAR) || 'F' AS market_bin
FROM obs GROUP BY station, date_local""")
def daily_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = summarize.daily_labels(observations(spark, sf_dir), DAY, "value", "ts", "k")
    return found.select(*DAY, *[c.alias(n) for n, c in rounded("final_tmax", "final_tmin").items()], "total_precip", "obs_count", micros(F.col("first_obs")).alias("first_obs_us"), micros(F.col("last_obs")).alias("last_obs_us"), "market_bin")


@query(f"""WITH {OBS}
SELECT event_id, station, date_local, value, max(value) OVER (PARTITION BY station, date_local ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS max_so_far FROM obs""")
def running_day_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).select("event_id", *DAY, "value", summarize.running_max("value", DAY, ["ts", "event_id"]).alias("max_so_far"))


def _rate_sql(hours: int) -> str:
    return f"""WITH {OBS}
SELECT o.event_id, o.station, o.date_local, round(o.value - p.value, 6) AS warming_rate
FROM obs o ASOF LEFT JOIN obs p ON o.station = p.station AND o.date_local = p.date_local AND o.ts - INTERVAL {hours} HOUR >= p.ts"""


def _rate(spark: SparkSession, sf_dir: str, hours: int) -> DataFrame:
    obs = observations(spark, sf_dir)
    before = asof.value_before("value", "ts", DAY, hours, "event_id")
    return obs.select("event_id", *DAY, F.round(F.col("value") - before, 6).alias("warming_rate"))


@query(_rate_sql(1))
def warming_rate_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 1)


@query(_rate_sql(3))
def warming_rate_3h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rate(spark, sf_dir, 3)


def _snapshot_sql() -> str:
    joins = "\n".join(f"ASOF LEFT JOIN obs h{h} ON s.station = h{h}.station AND s.cutoff - INTERVAL {h} HOUR >= h{h}.ts" for h in (1, 3, 6))
    return f"""WITH {OBS}, {SPINE}
SELECT s.station, s.date_local, l.value AS last_value, epoch_us(l.ts) AS matched_us, {", ".join(f"round(l.value - h{h}.value, 6) AS change_{h}h" for h in (1, 3, 6))}
FROM spine s ASOF LEFT JOIN obs l ON s.station = l.station AND s.cutoff >= l.ts {joins}"""


@query(_snapshot_sql())
def cutoff_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    found = asof.cutoff_snapshot(obs, spine(obs), ["station"], "ts", "cutoff", "value", tie=["event_id"])
    return found.select(*DAY, "last_value", micros(F.col("last_matched_at")).alias("matched_us"), *[c.alias(n) for n, c in rounded("change_1h", "change_3h", "change_6h").items()])


change_over_hours_sql = f"""WITH {OBS}
SELECT o.event_id, o.station, {", ".join(f"round(o.value - h{h}.value, 6) AS change_{h}h" for h in (1, 3, 6))}
FROM obs o {" ".join(f"ASOF LEFT JOIN obs h{h} ON o.station = h{h}.station AND o.ts - INTERVAL {h} HOUR >= h{h}.ts" for h in (1, 3, 6))}"""


@query(change_over_hours_sql)
def change_over_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asof.values_before(observations(spark, sf_dir), ["event_id", "station", "value"], "value", "ts", ["station"], (1, 3, 6), ["event_id"])
    return found.select("event_id", "station", *[F.round(F.col("value") - F.col(f"before_{h}h"), 6).alias(f"change_{h}h") for h in (1, 3, 6)])


@query(f"""WITH {OBS}, {SPINE}
SELECT s.station, s.date_local, round(avg(CASE WHEN o.ts > s.cutoff - INTERVAL 3 HOUR THEN o.value END), 6) AS mean_3h, max(o.value) AS max_6h, min(o.value) AS min_6h, CAST(sum(coalesce(o.k, 0)) AS BIGINT) AS sum_6h
FROM spine s LEFT JOIN obs o ON o.station = s.station AND o.ts <= s.cutoff AND o.ts > s.cutoff - INTERVAL 6 HOUR AND o.event_id IS NOT NULL
GROUP BY s.station, s.date_local HAVING count(o.event_id) > 0
UNION ALL
SELECT s.station, s.date_local, NULL, NULL, NULL, NULL FROM spine s
WHERE NOT EXISTS (SELECT 1 FROM obs o WHERE o.station = s.station AND o.ts <= s.cutoff AND o.ts > s.cutoff - INTERVAL 6 HOUR)""")
def trailing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    recent = F.col("ts") > F.col("cutoff") - F.expr("INTERVAL 3 HOURS")
    found = asof.window_before(
        obs.withColumnRenamed("date_local", "__own_day"), spine(obs), ["station"], "ts", "cutoff", 6,
        {"mean_3h": F.avg(F.when(recent, F.col("value"))), "max_6h": F.max("value"), "min_6h": F.min("value"), "sum_6h": F.sum(F.coalesce("k", F.lit(0)))}, "date_local", F.col("__own_day"),
    )
    return found.select(*DAY, F.round("mean_3h", 6).alias("mean_3h"), "max_6h", "min_6h", "sum_6h")


@query(f"""WITH {OBS}
SELECT event_id, station, round(avg(value) OVER w3, 6) AS mean_3h, max(value) OVER w6 AS max_6h, CAST(count(*) OVER w6 AS BIGINT) AS n_6h FROM obs
WINDOW w3 AS (PARTITION BY station ORDER BY epoch_us(ts) RANGE BETWEEN 10799999999 PRECEDING AND CURRENT ROW), w6 AS (PARTITION BY station ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW)""")
def rolling_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = asof.with_trailing(observations(spark, sf_dir), {"mean_3h": F.avg("value")}, "ts", ["station"], 3)
    found = asof.with_trailing(found, {"max_6h": F.max("value"), "n_6h": F.count("*")}, "ts", ["station"], 6)
    return found.select("event_id", "station", F.round("mean_3h", 6).alias("mean_3h"), "max_6h", "n_6h")


@query(f"""WITH {OBS}, {SPINE}
SELECT s.station, s.date_local, CASE WHEN o.ts > s.cutoff - INTERVAL 12 HOUR THEN o.value END AS nearby_value, o.ts IS NOT NULL AND o.ts > s.cutoff - INTERVAL 12 HOUR AS is_fresh
FROM spine s ASOF LEFT JOIN obs o ON s.station = o.station AND s.cutoff >= o.ts""")
def nearby_stale_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumn("seen", F.lit(True))
    found = asof.asof_backward(spine(obs), obs, ["station"], "cutoff", "ts", ["value", "seen"], "nearby_", ["event_id"], max_age_hours=12)
    return found.select(*DAY, "nearby_value", F.coalesce("nearby_seen", F.lit(False)).alias("is_fresh"))


HOURS = (6, 9, 12, 15, 18, 21)
_missing = " + ".join("CASE WHEN at_%02d IS NULL THEN 1 ELSE 0 END" % h for h in HOURS)


def _checkpoint_sql(rule: str) -> str:
    picks = {
        "first_non_null": "arg_min(value, (ts, event_id)) FILTER (hour_local = {h} AND value IS NOT NULL)",
        "first_row": "arg_min(value, (ts, event_id)) FILTER (hour_local = {h})",
        "last_row": "arg_max(value, (ts, event_id)) FILTER (hour_local = {h})",
    }
    columns = ", ".join(f"{picks[rule].format(h=h)} AS at_{h:02d}" for h in HOURS)
    return f"""WITH {OBS}, c AS (SELECT station, date_local, {columns}, count(DISTINCT hour_local) AS covered_hours FROM obs WHERE hour_local IN {HOURS} GROUP BY station, date_local)
SELECT *, CAST({_missing} AS BIGINT) AS missing_checkpoint_count FROM c"""


def _checkpoints(spark: SparkSession, sf_dir: str, rule: str) -> DataFrame:
    return summarize.checkpoints(observations(spark, sf_dir), DAY, "hour_local", "value", F.struct("ts", "event_id"), HOURS, rule)


@query(_checkpoint_sql("first_non_null"))
def hour_checkpoints_first_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checkpoints(spark, sf_dir, "first_non_null")


@query(_checkpoint_sql("first_row"))
def hour_checkpoints_first_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checkpoints(spark, sf_dir, "first_row")


@query(_checkpoint_sql("last_row"))
def hour_checkpoints_last_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checkpoints(spark, sf_dir, "last_row")


@query(f"""WITH {OBS}
SELECT station, date_local, max(value) AS day_max, min(value) AS day_min, round(max(value) - min(value), 6) AS day_range, round(avg(value), 6) AS day_mean,
    round(avg(value) FILTER (hour_local BETWEEN 6 AND 12), 6) AS morning_inclusive_mean, max(value) FILTER (hour_local >= 6 AND hour_local < 12) AS morning_half_open_max,
    max(value) FILTER (hour_local >= 12 AND hour_local < 18) AS afternoon_max, min(value) FILTER (hour_local < 6 OR hour_local >= 18) AS night_min,
    coalesce(bool_or(value <= 10 AND hour_local BETWEEN 6 AND 12), false) AS low_morning_any
FROM obs GROUP BY station, date_local""")
def day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    h, v = F.col("hour_local"), F.col("value")
    return observations(spark, sf_dir).groupBy(*DAY).agg(
        F.max(v).alias("day_max"), F.min(v).alias("day_min"), F.round(F.max(v) - F.min(v), 6).alias("day_range"), F.round(F.avg(v), 6).alias("day_mean"),
        F.round(F.avg(F.when(h.between(6, 12), v)), 6).alias("morning_inclusive_mean"), F.max(F.when((h >= 6) & (h < 12), v)).alias("morning_half_open_max"),
        F.max(F.when((h >= 12) & (h < 18), v)).alias("afternoon_max"), F.min(F.when((h < 6) | (h >= 18), v)).alias("night_min"),
        F.coalesce(F.bool_or((v <= 10) & h.between(6, 12)), F.lit(False)).alias("low_morning_any"),
    )


@query(f"""WITH {OBS}, n AS (SELECT station, event_type, count(*) AS c FROM obs GROUP BY ALL), m AS (SELECT station, k, count(*) AS c FROM obs WHERE k IS NOT NULL GROUP BY ALL)
SELECT station, (SELECT event_type FROM n WHERE n.station = s.station ORDER BY c DESC, event_type LIMIT 1) AS type_mode, (SELECT k FROM m WHERE m.station = s.station ORDER BY c DESC, k LIMIT 1) AS k_mode
FROM (SELECT DISTINCT station FROM obs) s""")
def stable_mode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy("station").agg(summarize.stable_mode("event_type").alias("type_mode"), summarize.stable_mode("k").alias("k_mode"))


@query(f"""WITH {OBS} SELECT station, date_local, hour_local AS tmax_hour FROM obs WHERE value IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY station, date_local ORDER BY value DESC, hour_local) = 1""")
def argmax_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.first_argmax(observations(spark, sf_dir), DAY, "value", "hour_local", "tmax_hour")


TYPES = ("click", "error", "purchase", "signup", "view")


@query(f"""WITH {OBS} SELECT station, date_local, {", ".join(f"round(avg(value) FILTER (event_type = '{t}'), 6) AS {t}" for t in TYPES)} FROM obs GROUP BY station, date_local""")
def long_to_wide_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy(*DAY).pivot("event_type", list(TYPES)).agg(F.round(F.avg("value"), 6))


@query(f"""WITH {OBS} SELECT station, date_local, string_agg(DISTINCT event_type, ';' ORDER BY event_type) AS codes, count(DISTINCT hour_local) AS hours_seen FROM obs GROUP BY station, date_local""")
def distinct_join_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return observations(spark, sf_dir).groupBy(*DAY).agg(summarize.distinct_text("event_type").alias("codes"), F.countDistinct("hour_local").alias("hours_seen"))


@query(f"""WITH {OBS}, seen AS (SELECT station, date_local, list(DISTINCT event_type) AS s FROM obs GROUP BY ALL)
SELECT station, date_local, array_to_string(list_sort(list_filter({list(TYPES)}, lambda x: NOT list_contains(s, x))), ';') AS missing, CAST(len(list_filter({list(TYPES)}, lambda x: NOT list_contains(s, x))) AS BIGINT) AS n_missing FROM seen""")
def missing_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = observations(spark, sf_dir).groupBy(*DAY).agg(F.collect_set("event_type").alias("s"))
    missing = F.array_sort(F.array_except(F.array(*map(F.lit, TYPES)), "s"))
    return seen.select(*DAY, F.array_join(missing, ";").alias("missing"), F.size(missing).cast("long").alias("n_missing"))


@query(f"""WITH {OBS}, b AS (SELECT station, min(date_local) AS a, max(date_local) AS z FROM obs GROUP BY station), s AS (SELECT station, CAST(unnest(generate_series(a, z, INTERVAL 1 DAY)) AS DATE) AS date_local FROM b)
SELECT s.station, s.date_local FROM s ANTI JOIN obs o ON s.station = o.station AND s.date_local = o.date_local""")
def date_spine_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).select(*DAY)
    bounds = obs.groupBy("station").agg(F.min("date_local").alias("first"), F.max("date_local").alias("last"))
    return summarize.date_spine(bounds, "first", "last", ["station"], "date_local").join(obs, DAY, "left_anti")


@query(f"""WITH {OBS}, d AS (SELECT station, date_local, max(value) AS tmax, min(value) AS tmin FROM obs GROUP BY ALL)
SELECT d.station, d.date_local, p.tmax AS previous_tmax, p.tmin AS previous_tmin, round(d.tmax - p.tmax, 6) AS tmax_change FROM d LEFT JOIN d p ON p.station = d.station AND p.date_local = d.date_local - 1""")
def previous_day_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = observations(spark, sf_dir).groupBy(*DAY).agg(F.max("value").alias("tmax"), F.min("value").alias("tmin"))
    before = days.select("station", F.date_add("date_local", 1).alias("date_local"), F.col("tmax").alias("previous_tmax"), F.col("tmin").alias("previous_tmin"))
    return days.join(before, DAY, "left").select(*DAY, "previous_tmax", "previous_tmin", F.round(F.col("tmax") - F.col("previous_tmax"), 6).alias("tmax_change"))


@query("""SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json_extract(props, '$.missing') AS BIGINT) IS NULL AS missing_field, event_type FROM events""")
def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("props", "k long, missing long")
    return table(spark, sf_dir, "events").select("event_id", parsed["k"].alias("k"), parsed["missing"].isNull().alias("missing_field"), "event_type")


@query(f"""WITH {OBS}, r AS (SELECT station, event_id, epoch_us(ts) AS s, epoch_us(ts) + k * 60000000 AS e FROM obs),
m AS (SELECT *, CASE WHEN max(e) OVER w IS NULL OR s > max(e) OVER w + 3600000000 THEN 1 ELSE 0 END AS fresh FROM r WINDOW w AS (PARTITION BY station ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY station ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS island FROM m)
SELECT station, min(s) AS start_us, max(e) AS end_us, count(*) AS n_ranges FROM g GROUP BY station, island""")
def range_merge_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = observations(spark, sf_dir).select("station", micros(F.col("ts")).alias("start_us"), (micros(F.col("ts")) + F.col("k") * 60_000_000).alias("end_us"))
    return summarize.merge_ranges(ranges, ["station"], "start_us", "end_us", 3_600_000_000).select("station", "start_us", "end_us", "n_ranges")


@query(f"""WITH {OBS} SELECT event_id, station, round(value - lag(value) OVER w, 6) AS delta, coalesce(value >= lag(value) OVER w, true) AS is_sorted FROM obs WINDOW w AS (PARTITION BY station ORDER BY ts, event_id)""")
def adjacent_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("station").orderBy("ts", "event_id")
    before = F.lag("value").over(w)
    return observations(spark, sf_dir).select("event_id", "station", F.round(F.col("value") - before, 6).alias("delta"), F.coalesce(F.col("value") >= before, F.lit(True)).alias("is_sorted"))


@query(f"""WITH {OBS} SELECT DISTINCT date_local, round(sin(dayofyear(date_local) * 2 * pi() / 365.25), 6) AS doy_sin, round(cos(dayofyear(date_local) * 2 * pi() / 365.25), 6) AS doy_cos,
    CAST(month(date_local) AS BIGINT) AS month, CASE WHEN month(date_local) BETWEEN 4 AND 10 THEN 'warm' ELSE 'cool' END AS season_apr_oct, CASE WHEN month(date_local) BETWEEN 5 AND 9 THEN 'warm' ELSE 'cool' END AS season_may_sep FROM obs""")
def calendar_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("date_local")
    sine, cosine = day_angle(day)
    return observations(spark, sf_dir).select("date_local").distinct().select("date_local", F.round(sine, 6).alias("doy_sin"), F.round(cosine, 6).alias("doy_cos"), F.month(day).cast("long").alias("month"), season(day).alias("season_apr_oct"), season(day, 5, 9).alias("season_may_sep"))


@query(f"""WITH {OBS} SELECT station, date_local, event_type, count(*) AS n, round(avg(value), 6) AS mean_value, CAST(grouping(station, date_local, event_type) AS BIGINT) AS level
FROM obs GROUP BY GROUPING SETS ((station, date_local), (event_type), ())""")
def grouping_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations(spark, sf_dir).createOrReplaceTempView("__obs_slices")
    return spark.sql("""SELECT station, date_local, event_type, count(*) AS n, round(avg(value), 6) AS mean_value, CAST(grouping_id() AS BIGINT) AS level
        FROM __obs_slices GROUP BY GROUPING SETS ((station, date_local), (event_type), ())""")
