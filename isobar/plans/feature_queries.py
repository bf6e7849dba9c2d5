"""Feature rows: day summaries, revisions, issue plans, predicates, scalar rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions import parse, units
from isobar.functions.timeops import cutoff, utc
from isobar.operators import asof, select, summarize
from isobar.operators.summarize import GRID_HOURS, GRID_REDUCED, GRID_WIND_HOURS
from isobar.plans import contracts
from isobar.plans.forecast_queries import FRAME, frame
from isobar.plans.observation_queries import DAY, spine
from isobar.plans.registry import OBS, SPINE, observations, query, table

# --- day summaries -------------------------------------------------------------

CELLS = f"""{OBS}, cells AS (SELECT station, date_local, hour_local, ts, event_id, CAST(event_id % 37 + 1 AS BIGINT) AS forecast_hour, round(value / 10 + 60) AS tmp, CASE event_id % 5 WHEN 0 THEN 'OVC' WHEN 1 THEN 'CLR' WHEN 2 THEN NULL ELSE 'BKN' END AS cld,
    CAST(event_id % 80 AS DOUBLE) AS cig, CAST(event_id % 11 AS DOUBLE) AS vis, CASE event_id % 4 WHEN 0 THEN 'FG' WHEN 1 THEN 'ng' WHEN 2 THEN ' ' END AS obv, CAST(event_id % 101 AS DOUBLE) AS p01, CASE WHEN event_id % 6 = 0 THEN CAST(event_id % 97 AS DOUBLE) END AS p06,
    CASE WHEN event_id % 12 = 0 THEN CAST(event_id % 89 AS DOUBLE) END AS p12, CAST(event_id % 83 AS DOUBLE) AS pos, CAST(event_id % 79 AS DOUBLE) AS poz, CASE event_id % 7 WHEN 0 THEN 'RA' WHEN 1 THEN 'NONE' WHEN 2 THEN 'SN' WHEN 3 THEN '' END AS typ FROM obs)"""


def bulletin_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations as hourly rows of a bulletin."""
    e = F.col("event_id")

    def number(n: int) -> Column:
        return (e % n).cast("double")

    return observations(spark, sf_dir).select(
        *DAY, "hour_local", "ts", "event_id", (e % 37 + 1).cast("long").alias("forecast_hour"), F.round(F.col("value") / 10 + 60).alias("tmp"), F.when(e % 5 == 0, "OVC").when(e % 5 == 1, "CLR").when(e % 5 > 2, "BKN").alias("cld"),
        number(80).alias("cig"), number(11).alias("vis"), F.when(e % 4 == 0, "FG").when(e % 4 == 1, "ng").when(e % 4 == 2, " ").alias("obv"), number(101).alias("p01"), F.when(e % 6 == 0, number(97)).alias("p06"), F.when(e % 12 == 0, number(89)).alias("p12"),
        number(83).alias("pos"), number(79).alias("poz"), F.when(e % 7 == 0, "RA").when(e % 7 == 1, "NONE").when(e % 7 == 2, "SN").when(e % 7 == 3, "").alias("typ"),
    )


_morning = "hour_local BETWEEN 6 AND 12"
_ranked = "SELECT station, date_local, {c} AS v, count(*) AS n FROM cells WHERE {c} IS NOT NULL AND {w} GROUP BY station, date_local, {c} QUALIFY row_number() OVER (PARTITION BY station, date_local ORDER BY n DESC, v) = 1"
BULLETIN_DAY = f"""{CELLS}, cld AS ({_ranked.format(c="cld", w=_morning)}), typ AS ({_ranked.format(c="typ", w="upper(trim(typ)) NOT IN ('', 'NG', 'NONE')")}),
day AS (SELECT station, date_local, min(forecast_hour) AS forecast_hour_min, max(forecast_hour) AS forecast_hour_max, count(*) AS target_day_row_count, max(tmp) AS day_tmp_max_f, min(tmp) AS day_tmp_min_f, max(tmp) - min(tmp) AS day_tmp_range_f,
    arg_min(hour_local, (-tmp, ts, event_id)) FILTER (tmp IS NOT NULL) AS day_tmp_argmax_local_hour, min(cig) FILTER ({_morning}) AS morning_cig_min, min(vis) FILTER ({_morning}) AS morning_vis_min,
    count(*) FILTER ({_morning} AND upper(trim(obv)) NOT IN ('', 'NG', 'NONE')) > 0 AS morning_obv_any, coalesce(min(cig) FILTER ({_morning}) <= 10 OR min(vis) FILTER ({_morning}) <= 3, false) AS morning_ifr_like_any,
    {", ".join(f"max({p}) AS day_{p}_max_pct" for p in ("p01", "p06", "p12", "pos", "poz"))}, count(*) FILTER (upper(trim(typ)) NOT IN ('', 'NG', 'NONE')) > 0 AS day_precip_type_any FROM cells GROUP BY station, date_local)"""


@query(f"WITH {BULLETIN_DAY} SELECT day.*, cld.v AS morning_cld_mode, typ.v AS day_precip_type_mode FROM day LEFT JOIN cld USING (station, date_local) LEFT JOIN typ USING (station, date_local)")
def bulletin_day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.bulletin_day(bulletin_cells(spark, sf_dir), DAY, "hour_local", F.struct("ts", "event_id"))


_sources = sorted({s for s, _ in GRID_HOURS.values()} | {s for s, _, _ in GRID_REDUCED.values()} | {"ugrd_850mb_ms", "vgrd_850mb_ms"})


def _grid_sql() -> str:
    raw = ", ".join(f"CASE WHEN (event_id + {j}) % 7 > 0 THEN value * {1 + j / 8} - {j} END AS {s}" for j, s in enumerate(_sources))
    parts = {"day": "true", "morning": "hour_local >= 6 AND hour_local < 12", "afternoon": "hour_local >= 12 AND hour_local < 18", "night": "hour_local <= 6"}
    functions = {"mean": "avg", "max": "max", "min": "min", "sum": "sum"}
    at = "arg_max_null({s}, (ts, event_id)) FILTER (hour_local = {h})"
    out = [f"round({at.format(s=s, h=h)}, 5) AS {name.format(h=f'{h:02d}')}" for name, (s, hours) in GRID_HOURS.items() for h in hours]
    out += [f"round({functions[r]}({s}) FILTER ({parts[p]}) + 1e-9, 5) AS {name}" for name, (s, r, p) in GRID_REDUCED.items()]
    for h in GRID_WIND_HOURS:
        u, v = at.format(s="ugrd_10m_ms", h=h), at.format(s="vgrd_10m_ms", h=h)
        out.append(f"round(CASE WHEN {u} = 0 AND {v} = 0 THEN NULL ELSE (270 - degrees(atan2({v}, {u})) + 360) % 360 END, 5) AS wind_10m_{h:02d}_local_direction_deg")
    out += ["bool_or(ltng_entire_atmosphere > 0) AS ltng_day_any", "round(avg(sqrt(ugrd_850mb_ms ** 2 + vgrd_850mb_ms ** 2)) + 1e-9, 5) AS wind_850mb_speed_day_mean_ms"]
    return f"WITH {OBS}, g AS (SELECT station % 50 AS station, date_local, hour_local, ts, event_id, {raw} FROM obs) SELECT station, date_local, {', '.join(out)} FROM g GROUP BY station, date_local"


@query(_grid_sql())
def gridded_day_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the gridded summary, over raw fields made from the observations."""
    raw = [F.when((F.col("event_id") + j) % 7 > 0, F.col("value") * (1 + j / 8) - j).alias(s) for j, s in enumerate(_sources)]
    rows = observations(spark, sf_dir).select((F.col("station") % 50).alias("station"), "date_local", "hour_local", "ts", "event_id", *raw)
    found = summarize.gridded_day(rows, DAY, "hour_local", F.struct("ts", "event_id"))
    reduced = {*GRID_REDUCED, "wind_850mb_speed_day_mean_ms"}
    return found.select(*DAY, *[(F.round(F.col(c) + 1e-9, 5) if c in reduced else F.col(c) if c == "ltng_day_any" else F.round(c, 5)).alias(c) for c in found.columns if c not in DAY])


@query(f"""WITH {OBS}, d AS (SELECT station, date_local, max(value) AS tmax, avg(value) AS tmean FROM obs GROUP BY ALL)
SELECT station, date_local, round(tmax, 6) AS tmax, {", ".join(f"round({v} - lag({v}, {k}) OVER w, 5) AS {v}_rev_{k}cycle" for v in ("tmax", "tmean") for k in (1, 2, 3))} FROM d WINDOW w AS (PARTITION BY station ORDER BY date_local)
QUALIFY row_number() OVER (PARTITION BY station ORDER BY date_local DESC) = 1""")
def lag_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = observations(spark, sf_dir).groupBy(*DAY).agg(F.max("value").alias("tmax"), F.avg("value").alias("tmean"))
    found = summarize.lag_revisions(days, ["station"], [F.desc("date_local")], ["tmax", "tmean"])
    return found.select(*DAY, F.round("tmax", 6).alias("tmax"), *[F.round(c, 5).alias(c) for c in found.columns if "_rev_" in c])


@query(f"""WITH {OBS} SELECT station, date_local, round(max(value), 6) AS day_max, round(min(value), 6) AS day_min, round(avg(value) + 1e-9, 6) AS day_mean, round(sum(value) + 1e-9, 5) AS day_sum, round(max(value) FILTER (hour_local >= 12), 6) AS late_max,
    bool_or(k > 95) AS any_large, CASE WHEN count(k) > 0 THEN count(DISTINCT k) ELSE count(*) END AS slots FROM obs GROUP BY ALL""")
def hourly_reducers(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir).withColumn("over", F.col("k") - 95)
    found = obs.groupBy(*DAY).agg(
        *[summarize.hourly(r, "value").alias(f"day_{r}") for r in ("max", "min", "mean", "sum")], summarize.hourly("max", "value", F.col("hour_local") >= 12).alias("late_max"), summarize.any_positive("over").alias("any_large"), summarize.slots_or_rows("k").alias("slots"),
    )
    return found.select(*DAY, *[F.round(c, 6).alias(c) for c in ("day_max", "day_min", "late_max")], F.round(F.col("day_mean") + 1e-9, 6).alias("day_mean"), F.round(F.col("day_sum") + 1e-9, 5).alias("day_sum"), "any_large", "slots")


@query("""SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS line1_quantity, max(CASE WHEN l_linenumber = 1 THEN l_returnflag END) AS line1_flag, max(CASE WHEN l_linenumber = 2 THEN l_quantity END) AS line2_quantity,
    max(CASE WHEN l_linenumber = 2 THEN l_returnflag END) AS line2_flag FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_returnflag) AS i FROM lineitem) WHERE i = 1 AND l_linenumber <= 2 GROUP BY l_orderkey""")
def multi_value_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").withColumn("line", F.concat(F.lit("line"), F.col("l_linenumber").cast("string"))).withColumnsRenamed({"l_quantity": "quantity", "l_returnflag": "flag"})
    return summarize.pivoted(rows, ["l_orderkey"], "line", ["line1", "line2"], ["quantity", "flag"], F.struct("l_partkey", "l_suppkey", "quantity", "flag"))


# --- issues --------------------------------------------------------------------

_local = "(ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York'"


@query(f"""WITH {OBS}, d AS (SELECT DISTINCT station, date_local FROM obs), w AS (SELECT station, date_local, ((date_local - INTERVAL 6 HOUR) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS a, ((date_local + INTERVAL 5 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS z FROM d)
SELECT w.station, w.date_local, arg_max(o.event_id, (o.ts, o.event_id)) AS cycle FROM w JOIN obs o ON o.station = w.station AND o.ts BETWEEN w.a AND w.z GROUP BY ALL""")
def overnight_cycle_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last event between 18:00 of the day before and 00:05, as the cycle that serves the day."""
    obs = observations(spark, sf_dir)
    start = utc(F.col("date_local").cast("timestamp_ntz") - F.expr("INTERVAL 6 HOURS"))
    cycles = obs.select("station", F.col("ts").cast("timestamp_ntz").alias("init"), F.col("event_id").alias("cycle"))
    last = cycles.groupBy("station", "init").agg(F.max("cycle").alias("cycle"))
    return asof.planned_cycles(last, obs.select(*DAY).distinct(), ["station"], "init", "date_local", start, cutoff(F.col("date_local")), ["cycle"]).select(*DAY, "cycle")


@query(f"""WITH {OBS}, {SPINE}, i AS (SELECT station, date_local, event_id AS issue, ts - INTERVAL 30 HOUR AS available, ts - INTERVAL 31 HOUR AS init, value FROM obs WHERE k % 2 = 0)
SELECT s.station, s.date_local, max(i.issue) FILTER (i.r = 1) AS issue, max(i.value) FILTER (i.r = 1) AS value FROM spine s LEFT JOIN (SELECT i.*, row_number() OVER (PARTITION BY i.station, i.date_local ORDER BY available DESC, init DESC, issue DESC) AS r FROM i JOIN spine USING (station, date_local) WHERE available <= cutoff) i USING (station, date_local) GROUP BY ALL""")
def issue_for_valid_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    t = F.col("ts").cast("timestamp_ntz")
    issues = obs.where("k % 2 = 0").select(*DAY, F.col("event_id").alias("issue"), (t - F.expr("INTERVAL 30 HOURS")).alias("available"), (t - F.expr("INTERVAL 31 HOURS")).alias("init"), "value")
    return asof.issue_for_day(issues, spine(obs), ["station"], "date_local", "available", "init", "cutoff", ["issue", "value"]).select(*DAY, "issue", "value")


@query(f"""WITH {OBS}, {SPINE}, l AS (SELECT s.*, o.value AS v1, o.ts AS t1 FROM spine s ASOF LEFT JOIN obs o ON s.station = o.station AND s.cutoff >= o.ts), b AS (SELECT l.*, o.value AS v0, o.ts AS t0 FROM l ASOF LEFT JOIN obs o ON l.station = o.station AND l.cutoff - INTERVAL 3 HOUR >= o.ts),
m AS (SELECT s.station, s.date_local, avg(o.k) AS wind FROM spine s JOIN obs o ON s.station = o.station AND o.ts <= s.cutoff AND o.ts > s.cutoff - INTERVAL 3 HOUR GROUP BY ALL)
SELECT b.station, b.date_local, CASE WHEN t1 > cutoff - INTERVAL 12 HOUR AND t0 IS NOT NULL THEN round(v1 - v0, 6) END AS value_change_3h, CASE WHEN t1 > cutoff - INTERVAL 12 HOUR AND t0 IS NOT NULL THEN round(wind + 1e-9, 6) END AS k_mean_3h FROM b LEFT JOIN m USING (station, date_local)""")
def nearby_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    found = asof.nearby_window(obs.withColumnRenamed("date_local", "__own"), spine(obs), ["station"], "ts", "cutoff", "value", "k", 3, "date_local", F.col("__own"), ["event_id"])
    return found.select(*DAY, F.round("value_change_3h", 6).alias("value_change_3h"), F.round(F.col("k_mean_3h") + 1e-9, 6).alias("k_mean_3h"))


@query(f"""WITH {OBS}, {SPINE}, i AS (SELECT station, ts, arg_max(value, event_id) AS value FROM obs GROUP BY station, ts), c AS (SELECT *, lag(value) OVER (PARTITION BY station ORDER BY ts) AS previous FROM i)
SELECT s.station, s.date_local, c.value AS latest_value, c.previous AS previous_value FROM spine s ASOF LEFT JOIN c ON s.station = c.station AND s.cutoff >= c.ts""")
def latest_issue_by_stretches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Issue choice sorted by stretches of a day: no task holds a whole station."""
    obs = observations(spark, sf_dir)
    issues = obs.groupBy("station", "ts").agg(F.max_by("value", "event_id").alias("value"))
    return asof.latest_issues(issues, spine(obs), ["station"], "ts", "cutoff", ["value"], bucket_hours=24).select(*DAY, "latest_value", "previous_value")


@query(f"""WITH {OBS}, lagged AS (SELECT o.station, o.date_local, o.ts, o.event_id, b.value AS before FROM obs o ASOF LEFT JOIN obs b ON o.station = b.station AND o.date_local = b.date_local AND o.ts - INTERVAL 1 HOUR >= b.ts)
SELECT event_id, before FROM lagged""")
def lag_without_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lag values stay on their own row: rows that share a time are not multiplied, as a join by time would."""
    obs = observations(spark, sf_dir)
    return obs.select("event_id", asof.value_before("value", "ts", DAY, 1, "event_id").alias("before"))


# --- predicates and columns ------------------------------------------------------

FIRST_DAY, LAST_DAY = "2024-01-05", "2024-01-20"


@query(f"""WITH {OBS} SELECT station, date_local, count(*) AS n, count(*) FILTER (date_local >= DATE '{FIRST_DAY}') OVER (PARTITION BY station) AS open_days FROM obs WHERE date_local BETWEEN DATE '{FIRST_DAY}' AND DATE '{LAST_DAY}' AND station IN (1, 2, 3, 5, 8) GROUP BY station, date_local""")
def day_and_station_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed window of ISO days, its open-ended form, and a station filter; both reach the scan's own aggregate."""
    from pyspark.sql import Window

    rows = contracts.in_window(observations(spark, sf_dir), "date_local", FIRST_DAY, LAST_DAY).where(F.col("station").isin(1, 2, 3, 5, 8)).groupBy(*DAY).agg(F.count("*").alias("n"))
    days = F.count_if(contracts.within(F.col("date_local"), FIRST_DAY, None)).over(Window.partitionBy("station"))
    return rows.select(*DAY, "n", days.alias("open_days"))


@query(f"""WITH {FRAME} SELECT station, date_local, (nbm IS NOT NULL AND lamp IS NOT NULL AND y IS NOT NULL) AS eligible, CASE WHEN nbm IS NULL THEN 'nbm' WHEN lamp IS NULL THEN 'lamp' WHEN y IS NULL THEN 'y' END AS first_missing FROM frame""")
def model_eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir)
    core = ["nbm", "lamp", "y"]
    missing = F.coalesce(*[F.when(~contracts.finite(F.col(c)), c) for c in core])
    return rows.select("station", "date_local", contracts.eligible([F.col("nbm").isNotNull(), F.col("lamp").isNotNull()], core).alias("eligible"), missing.alias("first_missing"))


#: Columns of parts under the names of features: what each is made of, whether a model may see it, and why.
CHOICE = [
    ("nbm_temp_max_f", "p_size", True, "feature"), ("nbm_temp_max_k", "p_retailprice", False, "converted"), ("lamp_wsp_kt_at_09", "p_partkey", False, "converted"), ("lamp_wsp_mph_at_09", "p_size + 1", True, "feature"), ("label_tmax_f", "p_size", False, "leak"),
    ("final_tmax_f", "p_size", False, "leak"), ("station_id", "p_brand", False, "not numeric"), ("meta_lamp_available", "p_size > 9", False, "meta"), ("selected_time_code", "p_size", False, "time code"), ("hrrr_flag", "p_size % 2 = 0", True, "feature"),
]


@query(" UNION ALL ".join(f"SELECT '{name}' AS name, {str(used).lower()} AS used, '{why}' AS reason, count({made}) AS n, count(DISTINCT {made}) AS different FROM part" for name, made, used, why in CHOICE))
def feature_column_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which columns of a table a model may see, and why not; and how many values each has."""
    rows = table(spark, sf_dir, "part").select(*[F.expr(made).alias(name) for name, made, _, _ in CHOICE])
    used = contracts.feature_columns(rows)
    counted = rows.agg(*[F.struct(F.lit(n).alias("name"), F.lit(n in used).alias("used"), F.lit(contracts.why_not(rows, n)).alias("reason"), F.count(n).alias("n"), F.countDistinct(n).alias("different")).alias(n) for n in rows.columns])
    return counted.select(F.explode(F.array(*rows.columns)).alias("c")).select("c.*")


@query(f"""WITH {FRAME} SELECT station, date_local AS target_date, nbm AS lamp_tmax, lamp AS meta_source_lamp, 'nbm 1, lamp 1, hrrr 1, other 4' AS counts FROM frame""")
def renamed_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rename map, prefixes and a keep-list; and how many columns each prefix had."""
    rows = frame(spark, sf_dir)
    counted = summarize.prefix_counts(rows.columns, ["nbm", "lamp", "hrrr"])
    out = contracts.renamed(rows, {"date_local": "target_date", "nbm": "tmax"}, prefixes={"tmax": "lamp_", "lamp": "meta_source_"}, keep=["station", "target_date", "lamp_tmax", "meta_source_lamp"])
    return out.withColumn("counts", F.lit(", ".join(f"{k} {v}" for k, v in counted.items())))


@query("SELECT p_partkey, p_name, p_size FROM part")
def unique_or_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passes as the key is unique; a repeated key ends the query."""
    return summarize.unique_or_error(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), ["p_partkey"])


# Fixed values of the example: fields and the levels they may come from, best first.
LEVELS = {"TMP": ("2 m above ground", "surface"), "GUST": ("10 m above ground", "surface"), "CAPE": ("surface",)}
_records = """SELECT CASE p_partkey % 3 WHEN 0 THEN 'TMP' WHEN 1 THEN 'GUST' ELSE 'VIS' END AS field, CASE WHEN p_size < 40 THEN 'surface' WHEN p_partkey % 3 = 0 THEN '2 m above ground' ELSE '10 m above ground' END AS level,
    CASE WHEN p_partkey % 3 = 1 AND p_size >= 40 THEN 'prob >10' WHEN p_size % 4 = 0 THEN 'ens mean' WHEN p_size % 4 = 1 THEN '10% level' ELSE '' END AS extra, p_partkey AS record FROM part"""


@query(f"""WITH r AS ({_records}), w AS (SELECT * FROM (VALUES ('TMP', '2 m above ground', 1), ('TMP', 'surface', 2), ('GUST', '10 m above ground', 1), ('GUST', 'surface', 2), ('CAPE', 'surface', 1)) v(field, level, preference)),
j AS (SELECT w.field, w.level, preference, extra, record FROM w LEFT JOIN (SELECT * FROM r WHERE NOT regexp_matches(extra, 'ens|%')) r ON r.field = w.field AND r.level = w.level),
b AS (SELECT field, arg_min({{'level': level, 'record': record, 'extra': extra}}, (preference, extra <> '', record)) FILTER (record IS NOT NULL) AS one FROM j GROUP BY field)
SELECT field, one.level AS level, CAST(one.record AS BIGINT) AS record, CASE WHEN one IS NULL THEN CASE WHEN field = 'CAPE' THEN 'missing optional' ELSE 'missing required' END WHEN one.extra = '' THEN 'exact' ELSE 'fallback' END AS status FROM b""")
def level_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each field's record: the best level, exact records before those with further text, no ensemble ones; a missing field is required or optional."""
    k, size = F.col("p_partkey"), F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.when(k % 3 == 0, "TMP").when(k % 3 == 1, "GUST").otherwise("VIS").alias("field"), F.when(size < 40, "surface").when(k % 3 == 0, "2 m above ground").otherwise("10 m above ground").alias("level"),
        F.when((k % 3 == 1) & (size >= 40), "prob >10").when(size % 4 == 0, "ens mean").when(size % 4 == 1, "10% level").otherwise("").alias("extra"), k.cast("long").alias("record"),
    )
    return select.preferred_levels(rows, LEVELS, required=("TMP", "GUST"))


# --- scalar rules ---------------------------------------------------------------

_number = "TRY_CAST(x AS DOUBLE)"


@query(f"""WITH v AS (SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'n/a' WHEN 1 THEN '' WHEN 2 THEN ' ' || p_size || '.5 ' ELSE CAST(p_size AS VARCHAR) END AS x FROM part) SELECT p_partkey, {_number} AS number, round(({_number} - 273.15) * 9 / 5 + 32, 6) AS f, round({_number} * 2.2369362921, 6) AS mph,
    round(({_number} - 32) * (5.0::DOUBLE / 9.0::DOUBLE) + 273.15, 6) AS k, round({_number} * 0.514444, 6) AS ms, round({_number} * 100 * 0.3048, 6) AS m, round({_number} * 1609.344, 4) AS metres FROM v""")
def coerced_and_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text to numbers (bad text is null), the models' transforms, and bulletin units back to SI."""
    n = F.col("p_size").cast("string")
    k = F.col("p_partkey") % 5
    x = F.when(k == 0, "n/a").when(k == 1, "").when(k == 2, F.concat(F.lit(" "), n, F.lit(".5 "))).otherwise(n)
    v = F.col("number")
    rows = table(spark, sf_dir, "part").select("p_partkey", x.try_cast("double").alias("number"))
    return rows.select(
        "p_partkey", "number", F.round(units.MODEL_TRANSFORMS["k_to_f"](v), 6).alias("f"), F.round(units.MODEL_TRANSFORMS["ms_to_mph"](v), 6).alias("mph"), F.round(units.TO_SI["f_to_k"](v), 6).alias("k"), F.round(units.TO_SI["kt_to_ms"](v), 6).alias("ms"),
        F.round(units.TO_SI["hundred_ft_to_m"](v), 6).alias("m"), F.round(units.TO_SI["mi_to_m"](v), 4).alias("metres"),
    )


_t, _d = "value / 10", "value / 10 - k / 5.0 + 2"


@query(f"""WITH {OBS} SELECT event_id, round(least(100, 100 * exp(17.67 * ({_d}) / (243.5 + {_d})) / exp(17.67 * ({_t}) / (243.5 + {_t}))), 4) AS rh FROM obs""")
def humidity_from_dewpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relative humidity of a temperature and a dewpoint that may lie above it."""
    t = F.col("value") / 10
    return observations(spark, sf_dir).select("event_id", F.round(units.relative_humidity(t, t - F.col("k") / 5.0 + 2), 4).alias("rh"))


@query("""WITH t AS (SELECT p_partkey, CASE p_partkey % 8 WHEN 0 THEN repeat('9', p_size % 4 + 1) WHEN 1 THEN '-' || p_size WHEN 2 THEN 'X' WHEN 3 THEN '' WHEN 4 THEN 'NG' WHEN 5 THEN ' ' || p_size || ' ' WHEN 6 THEN p_size || 'RA' ELSE CAST(p_size AS VARCHAR) END AS token FROM part)
SELECT p_partkey, token, CASE WHEN NOT regexp_full_match(trim(token), '9+') THEN TRY_CAST(trim(token) AS DOUBLE) END AS value FROM t""")
def bulletin_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of all kinds: nines alone are missing, a minus makes them a number, and text is none."""
    k, n = F.col("p_partkey") % 8, F.col("p_size").cast("string")
    token = (
        F.when(k == 0, F.repeat(F.lit("9"), (F.col("p_size") % 4 + 1).cast("int"))).when(k == 1, F.concat(F.lit("-"), n)).when(k == 2, "X").when(k == 3, "").when(k == 4, "NG").when(k == 5, F.concat(F.lit(" "), n, F.lit(" "))).when(k == 6, F.concat(n, F.lit("RA"))).otherwise(n)
    )
    return table(spark, sf_dir, "part").select("p_partkey", token.alias("token")).withColumn("value", parse.bulletin_value(F.col("token"), F.lit("TMP")))


@query("""SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y-%m-%d') || ' 12:00:00' AS TIMESTAMP) AS t, round(a) AS half_up, CAST(round_even(a, 0) AS BIGINT) AS half_even,
    'tmax-' || lower(strftime(o_orderdate, '%B')) || '-' || day(o_orderdate) || '-' || year(o_orderdate) AS slug FROM (SELECT *, (o_orderkey % 200 - 100) / 2.0::DOUBLE AS a FROM orders)""")
def times_degrees_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ISO text to instants, both roundings of halves, and the slug of a day's event."""
    a = (F.col("o_orderkey") % 200 - 100) / 2.0
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", parse.time_of(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T07:00:00-05:00"))).alias("t"), units.half_up_degree(a).cast("double").alias("half_up"), units.half_even_degree(a).alias("half_even"), parse.event_slug(day, "tmax").alias("slug"),
    )


@query("""SELECT n_nationkey, CAST(len(x) AS BIGINT) AS n, x[1] AS first, CAST(to_json(list_transform(x, lambda v: v || '!')) AS VARCHAR) AS back FROM (SELECT n_nationkey, CASE WHEN n_nationkey % 5 = 4 THEN NULL ELSE [n_name, CAST(n_regionkey AS VARCHAR)] END AS x FROM nation)""")
def json_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.when(F.col("n_nationkey") % 5 == 4, "no list").otherwise(F.to_json(F.array("n_name", F.col("n_regionkey").cast("string"))))
    rows = table(spark, sf_dir, "nation").select("n_nationkey", parse.json_list(text).alias("x"))
    return rows.select("n_nationkey", F.when(F.col("x").isNotNull(), F.size("x")).cast("long").alias("n"), F.try_element_at("x", F.lit(1)).alias("first"), F.to_json(F.transform("x", lambda v: F.concat(v, F.lit("!")))).alias("back"))


@query("""WITH c AS (SELECT s_suppkey, (s_suppkey * 37 % 360)::DOUBLE AS lon, 40 + s_suppkey % 10 AS lat FROM supplier), m AS (SELECT max(lon) > 180 AS wide FROM c)
SELECT s_suppkey, CASE WHEN lon > 180 THEN lon - 360 ELSE lon END AS lon_180, CASE WHEN wide AND lon - 200 < 0 THEN lon - 200 + 360 ELSE lon - 200 END AS in_grid, CASE WHEN wide THEN '0-360' ELSE '-180..180' END AS convention FROM c, m""")
def longitude_conventions(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isobar.operators import stencil

    rows = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") * 37 % 360).cast("double").alias("lon"))
    found = rows.agg(stencil.longitude_convention(F.col("lon")).alias("convention"))
    return rows.crossJoin(F.broadcast(found)).select("s_suppkey", stencil.to_180(F.col("lon")).alias("lon_180"), stencil.in_convention(F.col("lon") - 200, F.col("convention")).alias("in_grid"), "convention")


@query("""WITH c AS (SELECT r AS row, c AS col, 50.0::DOUBLE - r * 0.4 AS lat, ((170 + c * 0.7 + 180) % 360) - 180 AS lon FROM range(30) a(r), range(40) b(c)), p AS (SELECT c_custkey, 38 + c_custkey % 13 AS lat, CASE WHEN c_custkey % 2 = 0 THEN -176 ELSE 172 END + c_custkey % 7 AS lon FROM customer),
d AS (SELECT c_custkey, c.row, c.col, (p.lat - c.lat) ** 2 + least(abs(p.lon - c.lon), 360 - abs(p.lon - c.lon)) ** 2 AS d2 FROM p, c) SELECT c_custkey, CAST(row AS INTEGER) AS row, CAST(col AS INTEGER) AS col, round(d2, 6) AS distance2 FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY round(d2, 9), row, col) = 1""")
def nearest_grid_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest cell of every customer's place on a grid over the date line; places beside the grid widen their search."""
    from isobar.operators import stencil

    cells = spark.range(30).select(F.col("id").cast("int").alias("row")).crossJoin(spark.range(40).select(F.col("id").cast("int").alias("col")))
    cells = cells.select("row", "col", (50.0 - F.col("row") * 0.4).alias("lat"), ((170 + F.col("col") * 0.7 + 180) % 360 - 180).alias("lon"))
    key = F.col("c_custkey")
    points = table(spark, sf_dir, "customer").select("c_custkey", (38 + key % 13).cast("double").alias("lat"), (F.when(key % 2 == 0, -176).otherwise(172) + key % 7).cast("double").alias("lon"))
    return stencil.nearest_cell(cells, points, ["c_custkey"]).select("c_custkey", "row", "col", F.round("distance2", 6).alias("distance2"))


# --- contracts -------------------------------------------------------------------

CANONICAL = T.StructType([T.StructField("station", T.LongType()), T.StructField("temp_2m_k", T.DoubleType()), T.StructField("wind_10m_speed_ms", T.DoubleType()), T.StructField("ceiling_m", T.DoubleType()), T.StructField("visibility_m", T.DoubleType()), T.StructField("ptype_code", T.StringType()), T.StructField("cape_j_kg", T.DoubleType())])


@query(f"""WITH {CELLS} SELECT station, event_id, round((tmp - 32) * (5.0::DOUBLE / 9.0::DOUBLE) + 273.15, 6) AS temp_2m_k, round(pos * 0.514444, 6) AS wind_10m_speed_ms, round(cig * 100 * 0.3048, 6) AS ceiling_m, round(vis * 1609.344, 4) AS visibility_m, typ AS ptype_code, CAST(NULL AS DOUBLE) AS cape_j_kg FROM cells""")
def canonical_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A bulletin's columns in the shared schema's names and units; what it lacks is null."""
    mapping = {"temp_2m_k": ("tmp", "f_to_k"), "wind_10m_speed_ms": ("pos", "kt_to_ms"), "ceiling_m": ("cig", "hundred_ft_to_m"), "visibility_m": ("vis", "mi_to_m"), "ptype_code": ("typ", "copy")}
    cells = bulletin_cells(spark, sf_dir)
    found = contracts.canonical(cells, CANONICAL, mapping, keep=["event_id"])
    return found.select("station", "event_id", *[F.round(c, 4 if c == "visibility_m" else 6).alias(c) for c in ("temp_2m_k", "wind_10m_speed_ms", "ceiling_m", "visibility_m")], "ptype_code", "cape_j_kg")


#: Tables as sources: the prefix of their columns, whether they are on a grid, and the column of their longitudes.
SURFACES = {"customer": ("c_", True, "c_acctbal"), "supplier": ("s_", False, "s_acctbal"), "part": ("p_", True, "p_size"), "nation": ("n_", False, "n_nationkey")}
NEEDED = ("name", "nationkey")
_surface_facts = {"customer": ("", "partially synced"), "supplier": ("", "synced"), "part": ("nationkey", "partially synced"), "nation": ("", "synced")}


@query(" UNION ALL ".join(f"SELECT '{t}' AS source, '{_surface_facts[t][1]}' AS status, '{_surface_facts[t][0]}' AS missing, '' AS legacy, CASE WHEN max({lon}) > 180 THEN '0-360' ELSE '-180..180' END AS longitude, count(*) AS n FROM {t}" for t, (_, _, lon) in SURFACES.items()))
def contract_surfaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source's table stands from the shared contract: columns it lacks, old aliases, and its longitudes, where it is on a grid."""
    from isobar.operators.stencil import longitude_convention

    out = None
    for source, (prefix, on_grid, lon) in SURFACES.items():
        rows = table(spark, sf_dir, source)
        names = [c.removeprefix(prefix) for c in rows.columns]
        missing, legacy = sorted(set(NEEDED) - set(names)), contracts.legacy_aliases(names)
        found = rows.agg(longitude_convention(F.col(lon).cast("double")).alias("longitude"), F.count("*").alias("n"))
        status = F.lit(None).cast("string")
        for convention in ("0-360", "-180..180", "unknown"):
            status = F.when(F.col("longitude") == convention, contracts.surface(missing, legacy, convention, on_grid)).otherwise(status)
        one = found.select(F.lit(source).alias("source"), status.alias("status"), F.lit(";".join(missing)).alias("missing"), F.lit(";".join(legacy)).alias("legacy"), "longitude", "n")
        out = one if out is None else out.unionByName(one)
    return out


_kinds = ("click", "error", "view")


@query(f"""WITH {OBS}, h AS (SELECT 'h' || k % 12 AS feature, event_type FROM obs WHERE value > 20 + 12 * (k % 12)), f AS (SELECT 'h' || i AS feature FROM range(0, 12) r(i)),
m AS (SELECT f.feature, {", ".join(f"coalesce(bool_or(event_type = '{t}'), false) AS {t}" for t in _kinds)} FROM f LEFT JOIN h USING (feature) GROUP BY f.feature)
SELECT *, CASE {" + ".join(f"CAST({t} AS INTEGER)" for t in _kinds)} WHEN 0 THEN 'absent' WHEN 1 THEN 'one source' WHEN 3 THEN 'shared' ELSE 'partly shared' END AS status FROM m""")
def standardisation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which source (a type of event) gives which feature of the shared schema (a class of properties that some of its values reach)."""
    k = F.col("k") % 12
    seen = observations(spark, sf_dir).where(F.col("value") > 20 + 12 * k).where(F.col("event_type").isin(*_kinds)).groupBy("event_type").agg(F.collect_set(F.concat(F.lit("h"), k.cast("string"))).alias("features"))
    own = {r.event_type: r.features for r in seen.collect()}
    return contracts.matrix(spark, [f"h{i}" for i in range(12)], {t: own.get(t, []) for t in _kinds})


_anchor = "(nbm + lamp) / 2"


@query(f"""WITH {FRAME}, t AS (SELECT *, {_anchor} AS anchor, y - {_anchor} + CASE WHEN station = 3 THEN 1 ELSE 0 END AS residual, date_local + INTERVAL 5 MINUTE + CASE WHEN station = 4 THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END AS cut FROM frame)
SELECT count(*) AS row_count, count(*) FILTER (y IS NULL) AS label_missing, count(*) FILTER (y IS NOT NULL AND {_anchor} IS NULL) AS anchor_missing, count(*) FILTER (abs(residual - (y - anchor)) > 1e-6) AS residual_mismatch, count(*) FILTER (cut <> date_local + INTERVAL 5 MINUTE) AS cutoff_mismatch,
    CAST(0 AS BIGINT) AS duplicate_keys, CAST(1 AS BIGINT) AS forbidden_columns, CAST(0 AS BIGINT) AS unit_violations FROM t""")
def experiment_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An experiment's table: labels, anchors, the residual's formula, the cutoff, repeated keys, forbidden sources and names without their unit."""
    rows = frame(spark, sf_dir)
    anchor = (F.col("nbm") + F.col("lamp")) / 2
    wall = F.col("date_local").cast("timestamp_ntz") + F.expr("INTERVAL 5 MINUTES")
    rows = rows.select("*", anchor.alias("anchor_f"), (F.col("y") - anchor + F.when(F.col("station") == 3, 1).otherwise(0)).alias("residual_f"), F.when(F.col("station") == 4, wall + F.expr("INTERVAL 1 HOUR")).otherwise(wall).alias("cut"))
    return contracts.experiment_audit(rows, ["station", "date_local"], "y", "anchor_f", "residual_f", "cut", wall, forbidden=("hrrr",), units_of={"anchor_f": "f", "residual_f": "f"})


# --- SQL text ----------------------------------------------------------------------

SQL_TEXT = """SELECT n_name, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey JOIN {nation} n ON c.c_nationkey = n.n_nationkey GROUP BY n_name HAVING count(*) > 3"""


@query(SQL_TEXT.format(orders="orders", customer="customer", nation="nation"))
def sql_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same library through SQL text: tables are named in it and bound to frames."""
    return spark.sql(SQL_TEXT, **{t: table(spark, sf_dir, t) for t in ("orders", "customer", "nation")})


@query(f"""WITH {FRAME} SELECT station, count(*) AS n, round(avg(abs(nbm - y)) + 1e-9, 6) AS nbm_mae, round(avg(abs(lamp - y)) + 1e-9, 6) AS lamp_mae, CASE WHEN avg(abs(nbm - y)) <= avg(abs(lamp - y)) THEN 'nbm' ELSE 'lamp' END AS coldest FROM frame WHERE nbm IS NOT NULL AND lamp IS NOT NULL AND y IS NOT NULL GROUP BY station""")
def least_error_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The name of the least of several columns, the first of equals."""
    whole = frame(spark, sf_dir).where(contracts.eligible([], ["nbm", "lamp", "y"]))
    errors = whole.groupBy("station").agg(F.count("*").alias("n"), *[F.avg(F.abs(F.col(s) - F.col("y"))).alias(s) for s in ("nbm", "lamp")])
    return errors.select("station", "n", *[F.round(F.col(s) + 1e-9, 6).alias(f"{s}_mae") for s in ("nbm", "lamp")], select.name_of_least(["nbm", "lamp"]).alias("coldest"))


@query(f"""WITH {OBS} SELECT hour_local AS issue_hour, count(*) AS n, round(avg(abs(value)) + 1e-9, 6) AS mae FROM obs WHERE value IS NOT NULL GROUP BY hour_local ORDER BY round(avg(abs(value)), 9), n DESC, hour_local LIMIT 12""")
def best_issue_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = observations(spark, sf_dir).where("value IS NOT NULL").groupBy(F.col("hour_local").alias("issue_hour")).agg(F.count("*").alias("n"), F.avg(F.abs("value")).alias("mae"))
    return select.best_hours(found, "mae", "n", ["issue_hour"], 12).select("issue_hour", "n", F.round(F.col("mae") + 1e-9, 6).alias("mae"))

