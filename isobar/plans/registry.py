"""Named queries and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.functions.timeops import local

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under its function's name."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def places(x: Column | str, digits: int = 6) -> Column:
    """x to ``digits`` places, half up by the double of x * 10^digits, as SQL engines round doubles (Spark's own round goes by the shortest decimal of x)."""
    x = F.col(x) if isinstance(x, str) else x
    scale = F.lit(10.0**digits)
    return F.round(x.cast("double") * scale, 0) / scale


def rounded(*names: str, digits: int = 6) -> dict[str, Column]:
    return {n: places(n, digits) for n in names}


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as station observations: station, ts (UTC), local time, date and hour, type, value and k of the properties."""
    wall = local(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("user_id").alias("station"), "ts", wall.alias("ts_local"), wall.cast("date").alias("date_local"), F.hour(wall).cast("long").alias("hour_local"),
        "event_type", F.nanvl("value", F.lit(None)).alias("value"), F.get_json_object("props", "$.k").cast("long").alias("k"),
    )


OBS = """
obs AS (
    SELECT event_id, user_id AS station, ts, (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS ts_local,
        CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS date_local,
        CAST(hour((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York') AS BIGINT) AS hour_local,
        event_type, value, CAST(json_extract(props, '$.k') AS BIGINT) AS k
    FROM events
)"""
SPINE = """
spine AS (
    SELECT DISTINCT station, date_local, ((date_local + INTERVAL 5 MINUTE) AT TIME ZONE 'America/New_York') AT TIME ZONE 'UTC' AS cutoff FROM obs
)"""
