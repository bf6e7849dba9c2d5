"""Provenance, predicates, signatures and guarded choices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.timeops import local_date
from isobar.operators import asof, select, summarize
from isobar.plans.forecast_queries import BINS, CANDIDATES, FRAME, PRED, bins, folds, frame, predictions
from isobar.plans.registry import OBS, observations, query, table

FEATURES = {"nbm": ("direct", ("nbm",)), "anchor": ("derived", ("nbm", "lamp")), "best": ("fallback", ("native", "nbm"))}


@query(f"""WITH {FRAME} SELECT station, date_local, 'nbm' AS feature, CASE WHEN nbm IS NOT NULL THEN 'present' ELSE 'missing_optional' END AS status, CASE WHEN nbm IS NOT NULL THEN 'nbm' ELSE '' END AS sources FROM frame
UNION ALL SELECT station, date_local, 'anchor', CASE WHEN nbm IS NOT NULL AND lamp IS NOT NULL THEN 'derived' ELSE 'missing_optional' END, concat_ws(';', CASE WHEN nbm IS NOT NULL THEN 'nbm' END, CASE WHEN lamp IS NOT NULL THEN 'lamp' END) FROM frame
UNION ALL SELECT station, date_local, 'best', CASE WHEN native IS NOT NULL THEN 'present' WHEN nbm IS NOT NULL THEN 'fallback' ELSE 'missing_optional' END, concat_ws(';', CASE WHEN native IS NOT NULL THEN 'native' END, CASE WHEN nbm IS NOT NULL THEN 'nbm' END) FROM frame""")
def provenance_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarize.provenance(frame(spark, sf_dir), ["station", "date_local"], FEATURES)


@query(f"""WITH {FRAME} SELECT station, date_local, round(coalesce(native, nbm, lamp) + 1e-9, 6) AS chosen_f FROM frame""")
def fallback_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = summarize.without_source(frame(spark, sf_dir), "hrrr")
    return rows.select("station", "date_local", F.round(summarize.first_available(rows, ["hrrr", "native", "nbm", "lamp"]) + 1e-9, 6).alias("chosen_f"))


_bins = "(VALUES " + ", ".join(f"('{n}', {'NULL' if a is None else a}, {'NULL' if b is None else b})" for n, a, b in BINS) + ") b(name, lower, upper)"


@query(f"WITH {PRED} SELECT station, event_type, name, coalesce(upper < floor(q50), false) AS impossible FROM pred, {_bins}")
def impossible_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins wholly below what has been reached (here the whole degrees of the median) cannot come."""
    rows = predictions(spark, sf_dir).crossJoin(F.broadcast(bins(spark)))
    return rows.select("station", "event_type", "name", F.coalesce(F.col("upper") < F.floor("q50"), F.lit(False)).alias("impossible"))


@query(f"""WITH {OBS} SELECT event_id, CAST((ts - INTERVAL 6 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) = date_local AS usable,
    CASE WHEN CAST((ts - INTERVAL 6 HOUR) AT TIME ZONE 'UTC' AT TIME ZONE 'America/New_York' AS DATE) = date_local THEN max(value) OVER (PARTITION BY station ORDER BY epoch_us(ts) RANGE BETWEEN 21599999999 PRECEDING AND CURRENT ROW) END AS max_6h FROM obs""")
def six_hour_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A trailing six-hour maximum counts only where its window lies in the local day."""
    obs = observations(spark, sf_dir)
    usable = local_date(F.col("ts") - F.expr("INTERVAL 6 HOURS")) == F.col("date_local")
    found = asof.with_trailing(obs, {"max_6h": F.max("value")}, "ts", ["station"], 6)
    return found.select("event_id", usable.alias("usable"), F.when(usable, F.col("max_6h")).alias("max_6h"))


PATTERNS = (("metal", "ring|bolt"), ("tool", "widget|gear"), ("other", ".*"))


@query(f"""SELECT p_partkey, CASE {" ".join(f"WHEN regexp_matches(p_name, '{p}') THEN '{n}'" for n, p in PATTERNS)} END AS profile FROM part""")
def first_matching_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", summarize.first_pattern("p_name", PATTERNS).alias("profile"))


@query("""SELECT n_nationkey, sha256(concat_ws('|', CAST(n_nationkey AS VARCHAR), n_name, CAST(n_regionkey AS VARCHAR))) AS signature FROM nation""")
def row_signature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", summarize.signature(["n_nationkey", "n_name", "n_regionkey"]).alias("signature"))


@query("""WITH c AS (SELECT s_nationkey, s_suppkey % 50 AS "row", s_suppkey // 50 AS col, 40 + (s_suppkey % 50) * 0.1 AS lat, 280 + (s_suppkey // 50) * 0.5 AS lon FROM supplier)
SELECT s_nationkey, min("row") AS row_first, max("row") AS row_last, min(col) AS col_first, max(col) AS col_last, count(*) AS n_cells FROM c WHERE lat BETWEEN 41.0 AND 44.0 AND lon - 360 BETWEEN -80.0 AND -70.0 GROUP BY s_nationkey""")
def crop_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    row, col = k % 50, F.floor(k / 50).cast("long")
    cells = table(spark, sf_dir, "supplier").select("s_nationkey", row.alias("row"), col.alias("col"), (40 + row * F.expr("0.1D")).alias("lat"), (280 + col * 0.5).alias("lon"))
    return summarize.crop_box(cells, ["s_nationkey"], (41.0, 44.0), (-80.0, -70.0))


_datasets = f"""{CANDIDATES}, s AS (SELECT candidate, sum(mae * n) FILTER (fold < 2) / sum(n) FILTER (fold < 2) AS loss, sum(mae * n) FILTER (fold >= 2) / sum(n) FILTER (fold >= 2) AS confirmed FROM folds GROUP BY candidate), base AS (SELECT * FROM s WHERE candidate = 'half')"""


@query(f"""WITH {_datasets} SELECT s.candidate, round(s.loss + 1e-9, 6) AS loss FROM s, base WHERE s.candidate = 'half' OR (s.loss <= base.loss + 0.01 AND s.confirmed <= base.confirmed) ORDER BY s.candidate = 'half', s.loss, s.candidate LIMIT 1""")
def dual_guard_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A candidate must hold against the baseline on the selection folds and again on the confirmation folds."""
    def loss(part: Column) -> Column:
        return F.sum(F.when(part, F.col("mae") * F.col("n"))) / F.sum(F.when(part, F.col("n")))

    rows = folds(spark, sf_dir).groupBy("candidate").agg(loss(F.col("fold") < 2).alias("loss"), loss(F.col("fold") >= 2).alias("confirmed"))
    found = select.guarded_against(rows, F.col("candidate") == "half", {"loss": ("le", 0.01), "confirmed": ("le", 0.0)}, ["loss", "candidate"])
    return found.select("candidate", F.round(F.col("loss") + 1e-9, 6).alias("loss"))


@query(f"""WITH {OBS}, h AS (SELECT station, date_local, list(DISTINCT hour_local) AS hours FROM obs GROUP BY ALL) SELECT station, date_local, list_has_all(hours, [6, 12, 18]) AS covered, CAST(len(list_intersect(hours, [6, 9, 12, 15, 18, 21])) AS BIGINT) AS n_covered FROM h""")
def slot_containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    def slots(*hours: int) -> Column:
        return F.array(*[F.lit(h).cast("long") for h in hours])

    seen = observations(spark, sf_dir).groupBy("station", "date_local").agg(F.collect_set("hour_local").alias("hours"))
    return seen.select("station", "date_local", (F.size(F.array_except(slots(6, 12, 18), "hours")) == 0).alias("covered"), F.size(F.array_intersect("hours", slots(6, 9, 12, 15, 18, 21))).cast("long").alias("n_covered"))


@query(f"""WITH {OBS} SELECT station, count(DISTINCT k) AS n, true AS within_error FROM obs GROUP BY station""")
def approximate_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Approximate aggregates are opt-in; the exact count, and whether the sketch is off by no more than three of its standard errors of 2 per cent and one."""
    # A sketch is some kilobytes: none is made for a (station, k) pair, or for a station in every task that reads some of it.
    pairs = observations(spark, sf_dir).select("station", "k").repartition("station").distinct()
    found = pairs.groupBy("station").agg(F.approx_count_distinct("k", 0.02).alias("a"), F.count("k").alias("n"))
    return found.select("station", "n", (F.abs(F.col("a") - F.col("n")) <= 0.06 * F.col("n") + 1).alias("within_error"))


_messages = ["read timed out", "Connection reset by peer", "HTTP Error 503", "no_matching_records in file", "wgrib2 failed", "", "Broken pipe", "odd", "HTTP Error 404", "Too many requests", "cfgrib open failed", "pipe is gone"]
_errors = ["OSError", "ValueError", "TimeoutError", "Strange", "", "KeyError"]
_phases = ["download", "plan", "reduce", "upload"]
_decided = {0: ("timeout", "bounded"), 1: ("connection_reset", "bounded"), 2: ("remote_service_error", "bounded"), 3: ("no_matching_records", "never"), 6: ("broken_pipe", "bounded"), 9: ("rate_limited", "bounded")}


@query(f"""WITH {OBS}, r AS (SELECT event_id, k % 12 AS m, event_id % 6 AS e, station % 4 AS p, k % 8 + 1 AS attempt, (event_id % 100) / 100.0::DOUBLE AS jitter FROM obs),
d AS (SELECT *, CASE m {" ".join(f"WHEN {m} THEN '{c}'" for m, (c, _) in _decided.items())} ELSE CASE WHEN e IN (1, 5) THEN CASE e WHEN 1 THEN 'valueerror' ELSE 'keyerror' END WHEN e = 0 AND p IN (1, 3) AND m <> 11 THEN 'os_error' WHEN e = 0 THEN 'oserror' WHEN e = 2 THEN 'timeouterror'
    WHEN m IN (4, 10) THEN 'subprocess_or_decode_error' WHEN p IN (0, 2) THEN 'transient_phase_error' WHEN e = 4 THEN 'unknown_error' ELSE 'strange' END END AS error_class FROM r),
o AS (SELECT *, CASE WHEN m IN (0, 1, 2, 6, 9) OR error_class IN ('oserror', 'timeouterror') THEN 'bounded' WHEN error_class IN ('subprocess_or_decode_error', 'transient_phase_error') THEN 'single' ELSE 'never' END AS mode FROM d)
SELECT event_id, error_class, mode, attempt < 6 AND (mode = 'bounded' OR mode = 'single' AND attempt = 1) AS again, round(CASE WHEN attempt <= 1 THEN 0 ELSE least(30, least(30, 2 * pow(2, greatest(attempt - 2, 0))) * (0.8 + 0.4 * jitter)) END, 6) AS delay FROM o""")
def failure_retries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What failed attempts mean, whether they are tried again, and after how long."""
    from isobar.functions import failures

    def one_of(values: list[str], place: Column) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (place + 1).cast("int"))

    rows = observations(spark, sf_dir).select("event_id", failures.failure(one_of(_messages, F.col("k") % 12), one_of(_errors, F.col("event_id") % 6), one_of(_phases, F.col("station") % 4)).alias("f"), (F.col("k") % 8 + 1).alias("attempt"))
    again, delay = failures.try_again(F.col("attempt"), F.col("f.mode")), failures.delay_seconds(F.col("attempt"), (F.col("event_id") % 100) / 100.0)
    return rows.select("event_id", "f.error_class", "f.mode", again.alias("again"), F.round(delay, 6).alias("delay"))


@query("""WITH r AS (SELECT l_orderkey, l_linenumber AS record, CASE l_partkey % 3 WHEN 0 THEN 'TMP' WHEN 1 THEN 'APCP' ELSE 'WIND' END AS short, CASE l_suppkey % 3 WHEN 0 THEN 2 WHEN 1 THEN 10 END AS height, CASE l_linenumber % 3 WHEN 0 THEN 'accum' WHEN 1 THEN 'max' ELSE 'instant' END AS kind FROM lineitem),
a AS (SELECT o_orderkey, 'a' AS raster, 'tmp' AS short, 2 AS height, 'max' AS kind FROM orders UNION ALL SELECT o_orderkey, 'b', 'APCP', NULL, 'accum' FROM orders UNION ALL SELECT o_orderkey, 'c', 'wind', 10, NULL FROM orders)
SELECT l_orderkey, raster, CAST(record AS INTEGER) AS record FROM r JOIN a ON l_orderkey = o_orderkey AND lower(r.short) = lower(a.short) AND (a.kind IS NULL OR a.kind = r.kind) AND (a.height IS NULL OR r.height IS NULL OR a.height = r.height)""")
def raster_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records of a file that each of its rasters may hold, by name, height and kind of step."""
    from isobar.operators.select import matched_rasters

    part, supp, line = F.col("l_partkey") % 3, F.col("l_suppkey") % 3, F.col("l_linenumber") % 3
    records = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", F.col("l_linenumber").cast("int").alias("record"), F.when(part == 0, "TMP").when(part == 1, "APCP").otherwise("WIND").alias("short"),
        F.when(supp == 0, "2 m above ground").when(supp == 1, "10 m above ground").otherwise("surface").alias("level"), F.when(line == 0, "0-1 hour acc fcst").when(line == 1, "0-1 hour max fcst").otherwise("1 hour fcst").alias("step"),
    )
    three = F.explode(F.array(*[F.struct(F.lit(n).alias("raster"), F.lit(s).alias("short"), F.lit(h).cast("int").alias("height"), F.lit(k).cast("string").alias("step_kind")) for n, s, h, k in (("a", "tmp", 2, "max"), ("b", "APCP", None, "accum"), ("c", "wind", 10, None))]))
    rasters = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), three.alias("r")).select("l_orderkey", "r.*")
    return matched_rasters(records, rasters, ["l_orderkey"])


_phenomena = ["RA", "Light Rain", "fzra", "Mostly Cloudy", "T-Storm / Thunder", "??", "", "Smoke", "SN", "Freezing Drizzle"]
_amounts = ["RW", "nil", "PL", "", "ZR", "x", " ts "]


@query(f"""WITH {OBS}, t AS (SELECT event_id, k % 11 AS w, event_id % 8 AS p FROM obs)
SELECT event_id, list_extract([6, 6, 8, 2, 9, 1, 2, 3, 7, 8, 0], CAST(w + 1 AS INTEGER)) AS weather_id, list_extract([3, 2, 6, 0, 5, 1, 7, 0], CAST(p + 1 AS INTEGER)) AS precip_id FROM t""")
def weather_and_precip_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and phrases of weather, and types of precipitation, as ids of their vocabularies; what is not there and what is not known have ids, too."""
    from isobar.functions import encode

    def one_of(values: list[str], place: Column) -> Column:
        return F.try_element_at(F.array(*map(F.lit, values)), (place + 1).cast("int"))

    weather, amount = encode.weather_token(one_of(_phenomena, F.col("k") % 11)), encode.precip_token(one_of(_amounts, F.col("event_id") % 8))
    return observations(spark, sf_dir).select("event_id", encode.vocabulary_id(weather, encode.VOCABULARIES["weather_family"]).alias("weather_id"), encode.vocabulary_id(amount, encode.VOCABULARIES["precip_type"]).alias("precip_id"))


@query("""WITH known AS (SELECT DISTINCT p_name AS v FROM part WHERE p_partkey % 2 = 0), ids AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS id FROM known)
SELECT p_partkey, CAST(coalesce(id, -1) AS BIGINT) AS name_id, CAST(coalesce(list_position(['Brand#11', 'Brand#23', 'Brand#32'], p_brand), 0) - 1 AS BIGINT) AS brand_id FROM (SELECT p_partkey, p_brand, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS v FROM part) p LEFT JOIN ids USING (v)""")
def learned_label_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids learned from half of the parts and kept as a table for all of them, and ids of stored values; null and unseen are -1."""
    from isobar.functions import encode

    part = table(spark, sf_dir, "part")
    learned = encode.learned_ids(part.where("p_partkey % 2 = 0").select("p_name"), "p_name", "name_id").distinct()
    rows = part.select("p_partkey", "p_brand", F.when(F.col("p_partkey") % 7 != 0, F.col("p_name")).alias("p_name")).join(learned, "p_name", "left")
    return encode.learned_ids(rows, "p_brand", "brand_id", known=["Brand#32", "Brand#11", "Brand#23"]).select("p_partkey", F.coalesce("name_id", F.lit(-1)).cast("long").alias("name_id"), "brand_id")


@query(f"""WITH {OBS} SELECT event_id, round((value + 200 - 273.15) * 9 / 5 + 32, 6) AS tmp_2m_f, round(value / 10 * 9 / 5, 6) AS tmp_2m_f_3x3_std, round((k + 250 - 273.15) * 9 / 5 + 32, 6) AS tmp_2m_f_3x3_mean, round(k * 9 / 5.0, 6) AS tmp_2m_f_gradient_west_east, value AS tmp_surface_k,
    round(value * 2.2369362920544, 6) AS gust_mph, CASE WHEN value - k IS NULL THEN 'unknown' WHEN value - k >= 3 THEN 'warmer' WHEN value - k <= -3 THEN 'colder' ELSE 'near' END AS segment FROM obs""")
def converted_families(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A field with its statistics in other units, where differences are converted as differences; another by its suffix; and which way one lies from another."""
    from isobar.functions import encode, units

    v, k = F.col("value"), F.col("k")
    rows = observations(spark, sf_dir).select("event_id", (v + 200).alias("tmp_2m_k"), (v / 10).alias("tmp_2m_k_3x3_std"), (k + 250).alias("tmp_2m_k_3x3_mean"), k.alias("tmp_2m_k_gradient_west_east"), v.alias("tmp_surface_k"), v.alias("gust_ms"), encode.direction_segment(v - k).alias("segment"))
    found = units.convert_family(rows, "tmp_2m_k", "tmp_2m_f", "k_to_f")
    gust = units.convert_by_suffix(found.select("event_id", "gust_ms"))
    own = found.drop("gust_ms").join(gust, "event_id")
    return own.select("event_id", *[F.round(c, 6).alias(c) for c in ("tmp_2m_f", "tmp_2m_f_3x3_std", "tmp_2m_f_3x3_mean", "tmp_2m_f_gradient_west_east")], "tmp_surface_k", F.round("gust_mph", 6).alias("gust_mph"), "segment")
