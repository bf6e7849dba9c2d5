"""Folds, ensembles, payloads, parity and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.operators import folds
from isobar.operators.ladder import TAGS
from isobar.plans.forecast_queries import FRAME, PRED, frame, predictions
from isobar.plans.registry import OBS, observations, query, table
from isobar.session import scratch_path
from isobar.sources import market, sinks

ORIGINS = (("2024-01-10", "2024-01-11", "2024-01-15"), ("2024-01-15", "2024-01-16", "2024-01-20"), ("2024-01-20", "2024-01-21", "2024-01-31"))
_origins = "(VALUES " + ", ".join(f"({k}, DATE '{e}', DATE '{a}', DATE '{z}')" for k, (e, a, z) in enumerate(ORIGINS)) + ") o(fold, train_end, valid_start, valid_end)"


@query(f"""WITH {FRAME} SELECT CAST(fold AS BIGINT) AS fold, CASE WHEN date_local <= train_end THEN 'train' ELSE 'validation' END AS part, count(*) AS n, round(avg(y) + 1e-9, 6) AS mean_y FROM frame, {_origins}
WHERE date_local <= train_end OR date_local BETWEEN valid_start AND valid_end GROUP BY ALL""")
def rolling_origin_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folds.rolling_origin(frame(spark, sf_dir), "date_local", ORIGINS)
    return rows.groupBy("fold", "part").agg(F.count("*").alias("n"), F.round(F.avg("y") + 1e-9, 6).alias("mean_y"))


@query(f"""WITH {FRAME}, d AS (SELECT quantile_disc(date_local, 0.8) AS cut FROM (SELECT DISTINCT date_local FROM frame))
SELECT CASE WHEN date_local <= cut THEN 'train' ELSE 'validation' END AS part, count(*) AS n, min(date_local) AS first_day, max(date_local) AS last_day FROM frame, d GROUP BY 1""")
def chronological_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = folds.chronological_split(frame(spark, sf_dir), "date_local", 0.8)
    return rows.groupBy("part").agg(F.count("*").alias("n"), F.min("date_local").alias("first_day"), F.max("date_local").alias("last_day"))


_members = ("click", "view", "error")


@query(f"WITH {PRED} SELECT station, {', '.join(f'round(avg({t}) + 1e-9, 6) AS {t}' for t in TAGS)} FROM pred WHERE event_type IN {_members} GROUP BY station HAVING count(DISTINCT event_type) = 3")
def ensemble_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = folds.ensemble_mean(predictions(spark, sf_dir), ["station"], "event_type", TAGS, _members)
    return found.select("station", *[F.round(F.col(t) + 1e-9, 6).alias(t) for t in TAGS])


@query(f"""WITH {FRAME}, p AS (SELECT *, CASE WHEN station = 3 THEN nbm + 0.5 ELSE nbm END AS nbm2, CASE WHEN station = 4 THEN NULL ELSE lamp END AS lamp2 FROM frame)
SELECT 'nbm' AS "column", count(*) FILTER (station <> 5) AS "rows", count(*) FILTER (station = 5) AS unmatched, count(*) FILTER (station <> 5 AND (nbm IS NULL) <> (nbm2 IS NULL)) AS null_differs, round(max(abs(nbm - nbm2)) FILTER (station <> 5), 6) AS max_difference FROM p
UNION ALL SELECT 'lamp', count(*) FILTER (station <> 5), count(*) FILTER (station = 5), count(*) FILTER (station <> 5 AND (lamp IS NULL) <> (lamp2 IS NULL)), round(max(abs(lamp - lamp2)) FILTER (station <> 5), 6) FROM p""")
def parity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = frame(spark, sf_dir)
    station = F.col("station")
    changed = rows.where("station <> 5").withColumns({"nbm": F.when(station == 3, F.col("nbm") + 0.5).otherwise(F.col("nbm")), "lamp": F.when(station != 4, F.col("lamp"))})
    return folds.parity(rows, changed, ["station", "date_local"], ["nbm", "lamp"]).withColumn("max_difference", F.round("max_difference", 6))


@query(f"""WITH {OBS} SELECT station, date_local, count(*) AS n, max(value) AS tmax FROM obs GROUP BY ALL""")
def sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written by day with a manifest, validated, read back; a failed validation gives no rows."""
    rows = observations(spark, sf_dir).groupBy("station", "date_local").agg(F.count("*").alias("n"), F.max("value").alias("tmax"))
    path = scratch_path(spark, "sink")
    sinks.write_partitioned(rows, path, ["date_local"])
    bad = sinks.validate(spark, path, sinks.manifest(rows, ["date_local"]), rows.schema, ["date_local"], ["station"])
    stored = spark.read.parquet(path)
    return stored.join(bad, "date_local", "left_anti").select("station", "date_local", "n", "tmax")


@query(f"""WITH {OBS}, d AS (SELECT station, date_local, max(value) AS tmax FROM obs GROUP BY ALL), t AS (SELECT max(date_local) AS target FROM obs)
SELECT station, count(*) AS history_days, max(date_local) AS last_day, round(avg(tmax) + 1e-9, 6) AS mean_tmax FROM d, t WHERE date_local < target GROUP BY station""")
def label_history_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels strictly before the target day, the last one there is."""
    days = observations(spark, sf_dir).groupBy("station", "date_local").agg(F.max("value").alias("tmax"))
    target = days.agg(F.max("date_local").alias("target"))
    return days.crossJoin(F.broadcast(target)).where("date_local < target").groupBy("station").agg(F.count("*").alias("history_days"), F.max("date_local").alias("last_day"), F.round(F.avg("tmax") + 1e-9, 6).alias("mean_tmax"))


@query("""WITH b AS (SELECT p_partkey AS event, p_size AS n FROM part) SELECT event, n || '-' || (n + 2) AS name, n AS lower, n + 2 AS upper FROM b UNION ALL SELECT event, (n + 3) || ' or above', n + 3, NULL FROM b UNION ALL SELECT event, (n - 1) || ' or below', NULL, n - 1 FROM b WHERE n > 0""")
def market_event_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market documents made from the parts table, one a part, with a repeated and an unreadable market."""
    n = F.col("p_size")

    def entry(label: Column) -> Column:
        return F.struct(label.alias("groupItemTitle"))

    labels = [F.concat(n.cast("string"), F.lit("-"), (n + 2).cast("string")), F.concat((n + 3).cast("string"), F.lit(" or above")), F.concat((n - 1).cast("string"), F.lit(" or below")), F.lit("no bin"), F.concat(n.cast("string"), F.lit("-"), (n + 2).cast("string"))]
    docs = table(spark, sf_dir, "part").where("p_size > 0").select(F.col("p_partkey").alias("event"), F.to_json(F.struct(F.array(*map(entry, labels)).alias("markets"))).alias("text"))
    return market.event_bins(docs, "text", ["event"])
