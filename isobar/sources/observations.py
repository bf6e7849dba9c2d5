"""Station observations from JSON documents, one file a station and day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions.parse import metar_temperature_c, time_of
from isobar.functions.timeops import local, micros, utc
from isobar.functions.units import c_to_f, half_up_degree
from isobar.sources.tables import exists

_NUMBERS = ("temp", "dewPt", "rh", "pressure", "vis", "wspd", "wdir", "gust", "precip_hrly", "snow_hrly")
OBSERVATION = T.StructType([T.StructField("valid_time_gmt", T.LongType()), *(T.StructField(n, T.DoubleType()) for n in _NUMBERS), T.StructField("clds", T.StringType()), T.StructField("wx_phrase", T.StringType())])
DOCUMENT = T.StructType([T.StructField("metadata", T.StructType([T.StructField("status_code", T.IntegerType())])), T.StructField("observations", T.ArrayType(OBSERVATION))])
#: Field of a document -> column.
COLUMNS = {
    "temp": "temp_f", "dewPt": "dewpoint_f", "rh": "rh_pct", "pressure": "pressure_in", "vis": "visibility", "wspd": "wind_speed_mph", "wdir": "wind_dir_deg",
    "gust": "wind_gust_mph", "precip_hrly": "precip_hrly_in", "snow_hrly": "snow_hrly_in", "clds": "cloud_cover_code", "wx_phrase": "wx_phrase",
}


def documents(spark: SparkSession, folder: str, pattern: str, fallback: str = "*.json") -> DataFrame:
    """One row a file, with its name; files by ``pattern``, or by ``fallback`` if none match."""
    glob = pattern if exists(spark, f"{folder}/{pattern}") else fallback
    return spark.read.schema(DOCUMENT).option("multiLine", True).option("pathGlobFilter", glob).json(folder).select("*", F.col("_metadata.file_name").alias("source_file"))


def observations(docs: DataFrame, station: str) -> DataFrame:
    """One row an observation: times, measures, station and file. A file without observations gives none."""
    rows = docs.select("source_file", F.explode("observations").alias("o"))
    utc = F.timestamp_seconds("o.valid_time_gmt").cast("timestamp_ntz")
    return rows.select(
        F.lit(station).alias("station_id"), utc.alias("valid_time_utc"), local(utc).alias("valid_time_local"), local(utc).cast("date").alias("date_local"),
        *[F.col(f"o.{name}").alias(column) for name, column in COLUMNS.items()], "source_file",
    )


def file_quality(docs: DataFrame, low: int = 20, high: int = 30, day: Column | None = None) -> DataFrame:
    """Per file: status, count, whether its times are unsorted or its count unusual, and, where ``day`` gives its local day, how many times lie outside and whether the clocks change on it."""
    times = F.transform("observations", lambda o: o["valid_time_gmt"])
    n = F.coalesce(F.size("observations"), F.lit(0))
    out = [F.col("source_file"), F.col("metadata.status_code").alias("status_code"), n.alias("obs_count"), (times != F.array_sort(times)).alias("unsorted"), (n < low).alias("low_count"), (n > high).alias("high_count"), (F.coalesce("metadata.status_code", F.lit(0)) != 200).alias("bad_status")]
    if day is not None:
        outside = F.filter(times, lambda t: local(F.timestamp_seconds(t).cast("timestamp_ntz")).cast("date") != day)
        out += [F.coalesce(F.size(outside), F.lit(0)).alias("out_of_day"), (micros(utc(F.date_add(day, 1))) - micros(utc(day)) != 86_400_000_000).alias("clock_change")]
    return docs.select(*out)


# METAR: remarks hold the temperature in tenths, and a six-hour maximum.
METAR = "array<struct<rawOb:string,temp:double,maxT:double,obsTime:string,receiptTime:string>>"


def metars(texts: DataFrame, text: str, by: list[str]) -> DataFrame:
    """Rows of METAR JSON: temperatures (from the remark's tenths, else the rounded field), six-hour maximum, times; rows without a temperature or a time are left out."""
    rows = texts.select(*by, F.explode(F.from_json(F.col(text), METAR)).alias("m"))
    c = metar_temperature_c(F.col("m.rawOb"), F.col("m.temp"))
    found = rows.select(*by, c.alias("temp_c"), c_to_f(c).alias("temp_f"), half_up_degree(c_to_f(c)).alias("rounded_temp_f"), half_up_degree(c_to_f(F.col("m.maxT"))).alias("rounded_max_f"), time_of(F.col("m.obsTime")).alias("obs_utc"), time_of(F.col("m.receiptTime")).alias("receipt_utc"))
    return found.where("temp_c IS NOT NULL AND obs_utc IS NOT NULL")


def day_maximum(found: DataFrame, by: list[str], day: str) -> DataFrame:
    """The largest whole degree reached on each local day; a six-hour maximum counts only where its window lies in the day."""
    start = F.col("obs_utc") - F.expr("INTERVAL 6 HOURS")
    inside = micros(start) >= micros(utc(F.col(day)))
    return found.groupBy(*by, day).agg(F.max(F.greatest(F.col("rounded_temp_f"), F.when(inside, F.col("rounded_max_f")))).alias("max_so_far_f"), F.max("obs_utc").alias("last_obs_utc"))
