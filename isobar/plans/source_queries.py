"""Sources and sinks, over texts and files made from the tables: the SQL says what must come out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.plans.registry import OBS, observations, query, table
from isobar.session import scratch_path
from isobar.sources import observations as documents
from isobar.sources import sinks, tables, text



def _n() -> Column:
    return F.col("n_nationkey")


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")


def _history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON document for each nation, written one a folder, and read as a station's history is: by a pattern that nothing fits, then by the fallback."""
    hours = F.when(_n() % 4 == 0, F.array().cast("array<int>")).otherwise(F.sequence(F.lit(1), (_n() % 4).cast("int")))
    entry = F.transform(hours, lambda i: F.struct((1678608000 + F.when(_n() % 5 == 0, 4 - i).otherwise(i) * 3600).cast("long").alias("valid_time_gmt"), (_n() + 40 + i).cast("double").alias("temp"), F.lit(0.25).alias("precip_hrly"), F.concat(F.lit("N"), _n().cast("string")).alias("clds")))
    doc = F.to_json(F.struct(F.struct(F.when(_n() % 7 == 0, 500).otherwise(200).alias("status_code")).alias("metadata"), entry.alias("observations")))
    at = scratch_path(spark, "history")
    _nations(spark, sf_dir).select(_n().alias("nation"), doc.alias("value")).repartition("nation").write.partitionBy("nation").text(at)
    return documents.documents(spark, at, "KLGA_9_US_*.json", fallback="part-*")


_hours = "CASE WHEN n_nationkey % 5 = 0 THEN 4 - i ELSE i END"


@query(f"""SELECT 'N' || n_nationkey AS cloud_cover_code, (to_timestamp(1678608000 + ({_hours}) * 3600) AT TIME ZONE 'UTC') AS valid_time_utc, ((to_timestamp(1678608000 + ({_hours}) * 3600)) AT TIME ZONE 'America/New_York') AS valid_time_local,
    CAST((to_timestamp(1678608000 + ({_hours}) * 3600)) AT TIME ZONE 'America/New_York' AS DATE) AS date_local, CAST(n_nationkey + 40 + i AS DOUBLE) AS temp_f, 0.25::DOUBLE AS precip_hrly_in FROM nation, range(1, 4) r(i) WHERE i <= n_nationkey % 4""")
def json_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents.observations(_history(spark, sf_dir), "KLGA")
    return rows.select("cloud_cover_code", "valid_time_utc", "valid_time_local", "date_local", "temp_f", "precip_hrly_in")


@query("""SELECT CAST(n_nationkey AS VARCHAR) AS source_file, CASE WHEN n_nationkey % 7 = 0 THEN 500 ELSE 200 END AS status_code, CAST(n_nationkey % 4 AS INTEGER) AS obs_count, n_nationkey % 5 = 0 AND n_nationkey % 4 > 1 AS unsorted, n_nationkey % 4 < 2 AS low_count, n_nationkey % 4 > 2 AS high_count,
    n_nationkey % 7 = 0 AS bad_status, CAST(CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE n_nationkey % 4 END AS INTEGER) AS out_of_day, n_nationkey % 2 = 0 AS clock_change FROM nation""")
def file_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the day on which the clocks change, and, for odd nations, of the day after, in which none of their times lie."""
    docs = _history(spark, sf_dir).withColumn("source_file", F.col("nation").cast("string"))
    day = F.date_add(F.lit("2023-03-12").cast("date"), (F.col("nation") % 2).cast("int"))
    return documents.file_quality(docs, low=2, high=2, day=day)


def _bulletins(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.lpad((_n() + 10).cast("string"), 2, "0")
    station = F.concat(F.lit("K"), F.lpad(_n().cast("string"), 3, "0"))
    lines = [F.concat(F.lit(" "), station, F.lit("   LAMP GUIDANCE   4/12/2026  2230 UTC")), F.lit(" UTC  23 00 01"), F.concat(F.lit(" TMP  "), n, F.lit(" 99  X")), F.concat(F.lit(" CIG   9 NG  "), (_n() % 8).cast("string"))]
    return _nations(spark, sf_dir).select(F.concat(F.lit("b"), _n().cast("string")).alias("source_path"), F.concat_ws("\n", *lines, F.lit(" KZZZ   LAMP GUIDANCE   4/12/2026  2230 UTC"), F.lit(" UTC  23"), F.lit(" TMP  50")).alias("text"))


@query("""SELECT 'K' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS station, label, CAST(h AS INTEGER) AS forecast_hour, TIMESTAMP '2026-04-12 22:00:00' + INTERVAL (h) HOUR AS valid_utc, token, CAST(value AS DOUBLE) AS value FROM nation, LATERAL (VALUES
    ('TMP', 1, CAST(n_nationkey + 10 AS VARCHAR), n_nationkey + 10), ('TMP', 2, '99', NULL), ('TMP', 3, 'X', NULL), ('CIG', 1, '9', NULL), ('CIG', 2, 'NG', NULL), ('CIG', 3, CAST(n_nationkey % 8 AS VARCHAR), n_nationkey % 8)) v(label, h, token, value)
UNION ALL SELECT 'KZZZ', 'TMP', 1, TIMESTAMP '2026-04-12 23:00:00', '50', 50.0 FROM nation""")
def bulletin_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Station blocks of fixed cells: hours roll over midnight, nines and X are no numbers, the last block ends with its file."""
    found = text.bulletin_hours(text.bulletin_rows(_bulletins(spark, sf_dir)))
    return found.select("station", "label", "forecast_hour", "valid_utc", "token", "value")


@query("""SELECT 'b' || n_nationkey AS name, CAST(n_regionkey AS BIGINT) AS region FROM nation WHERE n_nationkey % 3 < 2""")
def archived_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts in compressed files, and of an archive's members only those of the wanted days and cycles."""
    at = scratch_path(spark, "archive")
    name = F.concat(F.lit("b"), _n().cast("string"))
    member = F.concat(F.lit("lamp."), F.when(_n() % 3 == 0, "20240105").when(_n() % 3 == 1, "20240106").otherwise("20240107"), F.lit("_"), F.when(_n() % 2 == 0, "04").otherwise("05"), F.lit("30z.txt"))
    _nations(spark, sf_dir).select(F.concat_ws(",", name, member, F.col("n_regionkey").cast("string")).alias("value")).repartition(3).write.option("compression", "gzip").text(at)
    lines = text.whole_texts(spark, at, "part-*").select(F.explode(F.split(F.trim("text"), "\n")).alias("line"))
    members = lines.select(F.split_part("line", F.lit(","), F.lit(1)).alias("name"), F.split_part("line", F.lit(","), F.lit(2)).alias("member"), F.split_part("line", F.lit(","), F.lit(3)).cast("long").alias("region"))
    return text.chosen_members(members, "2024-01-05", "2024-01-06", [4, 5]).select("name", "region")


@query("""SELECT n_nationkey AS nation, round(c, 4) AS temp_c, CAST(round(c * 9 / 5 + 32) AS BIGINT) AS rounded_temp_f, CASE WHEN n_nationkey % 3 = 0 THEN 86 END AS rounded_max_f, TIMESTAMP '2024-01-01 00:00:00' + INTERVAL (n_nationkey) HOUR AS obs_utc FROM (SELECT n_nationkey, CASE n_nationkey % 3 WHEN 0 THEN n_nationkey / 10.0 WHEN 1 THEN -n_nationkey / 10.0 ELSE n_nationkey END AS c FROM nation WHERE n_nationkey % 8 <> 7)""")
def metar_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Temperatures from the remark's tenths, warm and cold, else from the field; times as numbers or as text; rows without either are left out."""
    tenths = F.lpad(_n().cast("string"), 3, "0")
    raw = F.when(_n() % 3 == 0, F.concat(F.lit("METAR RMK T0"), tenths, F.lit("0011"))).when(_n() % 3 == 1, F.concat(F.lit("METAR RMK T1"), tenths, F.lit("1011")))
    at = 1704067200 + _n() * 3600
    when = F.when(_n() % 8 == 7, "no time").when(_n() % 2 == 0, at.cast("string")).otherwise(F.concat(F.date_format(F.timestamp_seconds(at), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
    row = F.struct(raw.alias("rawOb"), _n().cast("double").alias("temp"), F.when(_n() % 3 == 0, 30.0).alias("maxT"), when.alias("obsTime"))
    texts = _nations(spark, sf_dir).select(_n().alias("nation"), F.to_json(F.array(row)).alias("json"))
    return documents.metars(texts, "json", ["nation"]).select("nation", F.round("temp_c", 4).alias("temp_c"), "rounded_temp_f", F.col("rounded_max_f").cast("int").alias("rounded_max_f"), "obs_utc")


@query("""SELECT r_regionkey AS k, r_name AS name, CAST(NULL AS DOUBLE) AS extra, 'one' AS batch FROM region WHERE r_regionkey < 3 UNION ALL SELECT r_regionkey, NULL, r_regionkey / 2.0, 'two' FROM region WHERE r_regionkey >= 3""")
def named_parquets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of several schemas below one folder, an empty one among them: a column that is null everywhere goes, the folder's name is a value."""
    root = scratch_path(spark, "named")
    region, k = table(spark, sf_dir, "region"), F.col("r_regionkey")
    region.where(k < 3).select(k.alias("k"), F.col("r_name").alias("name"), F.lit(None).cast("string").alias("unused")).coalesce(1).write.parquet(f"{root}/batch=one")
    region.where(k >= 3).select(k.alias("k"), (k / 2.0).cast("double").alias("extra")).coalesce(1).write.parquet(f"{root}/batch=two")
    region.where(k < 0).select(k.alias("k")).coalesce(1).write.parquet(f"{root}/batch=three")
    found = tables.named_parquets(spark, root, "part-*.parquet", drop_empty=True)
    assert "unused" not in found.columns
    return tables.with_partition_value(found, "batch")


@query("SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_nosuch, c_acctbal FROM customer UNION ALL SELECT s_suppkey, 'supplier', NULL FROM supplier WHERE false")
def pruned_and_optional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of a wide table and one that it lacks; a table that is not there gives no rows."""
    schema = T.StructType([T.StructField("c_custkey", T.LongType()), T.StructField("c_nosuch", T.StringType()), T.StructField("c_acctbal", T.DoubleType())])
    there = tables.pruned_parquet(spark, f"{sf_dir}/customer.parquet", schema.names, schema)
    return tables.union_by_name([there, tables.optional_parquet(spark, f"{sf_dir}/no_such_table.parquet", schema)])


_manifest = "o_orderkey AS k, o_orderstatus <> 'F' AS fine, strftime(o_orderdate, '%Y-%m-%d') AS d"


@query(f"""WITH m AS (SELECT {_manifest} FROM orders), p AS (
    SELECT k, d, CASE WHEN k % 6 = 0 THEN '/repo/a' || k || '.parquet' ELSE '/m/' || k || '/a' || k || '.parquet' END AS path FROM m WHERE fine AND k % 3 = 0
    UNION ALL SELECT k, d, '/abs/' || k || '.parquet' FROM m WHERE fine AND k % 3 = 1 AND k % 9 <> 1
    UNION ALL SELECT k, d, '/m/' || k || '/wide.parquet' FROM m WHERE fine AND k % 3 = 2 AND k % 12 = 2)
SELECT path, CAST(d || CASE WHEN k % 2 = 0 THEN ' 05:00:00' ELSE ' 06:00:00' END AS TIMESTAMP) AS available_utc FROM p""")
def issue_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as manifests of issues: those that are ok, their paths as they are, below the repository, then below the manifest; those that are nowhere are left out."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    text, name = k.cast("string"), F.concat(F.lit("a"), k.cast("string"), F.lit(".parquet"))
    folder = F.concat(F.lit("/m/"), text)
    absolute = F.concat(F.lit("/abs/"), text, F.lit(".parquet"))
    orders = table(spark, sf_dir, "orders")
    manifests = orders.select(
        F.when(F.col("o_orderstatus") != "F", "ok").otherwise("failed").alias("extraction_status"), F.when(k % 3 == 0, name).when(k % 3 == 1, absolute).alias("wide_output_paths"),
        F.concat(day, F.lit("T05:00:00Z")).alias("init_time_utc"), F.when(k % 2 == 1, F.concat(day, F.lit("T06:00:00Z"))).alias("processed_timestamp_utc"), folder.alias("folder"),
    )
    at = F.when(k % 6 == 0, F.concat(F.lit("/repo/"), name)).when(k % 3 == 0, F.concat(folder, F.lit("/"), name)).when((k % 3 == 1) & (k % 9 != 1), absolute).when(k % 12 == 2, F.concat(folder, F.lit("/wide.parquet")))
    found = tables.issue_catalog(manifests, "wide.parquet", "/repo", "folder", orders.select(at.alias("path")).where("path IS NOT NULL"))
    return found.select(F.col("resolved_path").alias("path"), F.col("available_utc").cast("timestamp_ntz").alias("available_utc"))


@query("SELECT '/a/' || o_custkey || '/x.txt' AS resolved, count(*) AS named FROM orders GROUP BY o_custkey")
def distinct_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that are named again and again, each time in another way."""
    c, way = F.col("o_custkey").cast("string"), F.col("o_orderkey") % 5
    path = (
        F.when(way == 0, F.concat(F.lit("/a/"), c, F.lit("/x.txt"))).when(way == 1, F.concat(F.lit("/a/./"), c, F.lit("//x.txt"))).when(way == 2, F.concat(F.lit("/a/b/../"), c, F.lit("/x.txt")))
        .when(way == 3, F.concat(F.lit("file:///a/"), c, F.lit("/x.txt"))).otherwise(F.concat(F.lit("/../a/"), c, F.lit("/./x.txt")))
    )
    return tables.distinct_inputs(table(spark, sf_dir, "orders").select(path.alias("path"))).select("resolved", "named")


# --- sinks -------------------------------------------------------------------------


@query(f"""WITH {OBS} SELECT month(date_local) AS month, event_type, station % 3 AS lane, count(*) AS n FROM obs GROUP BY ALL""")
def three_level_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Partitions in three levels, replaced one by one: the second write renews its own only."""
    at, keys = scratch_path(spark, "levels"), ["month", "event_type", "lane"]
    rows = observations(spark, sf_dir).groupBy(F.month("date_local").cast("long").alias("month"), "event_type", (F.col("station") % 3).alias("lane")).agg(F.count("*").alias("n"))
    sinks.write_partitioned(rows.withColumn("n", F.when(F.col("event_type") == "view", -1).otherwise(F.col("n")).cast("long")), at, keys)
    sinks.write_partitioned(rows.where("event_type = 'view'"), at, keys)
    return spark.read.parquet(at).select(F.col("month").cast("long").alias("month"), "event_type", F.col("lane").cast("long").alias("lane"), "n")


@query("""SELECT n_regionkey AS region, CASE n_regionkey WHEN 1 THEN 'row_count' WHEN 2 THEN 'duplicate_key' WHEN 3 THEN 'status' END AS problems FROM nation WHERE n_regionkey IN (1, 2, 3) GROUP BY ALL""")
def sink_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a read-back finds: a partition whose count is not its manifest's, one with a repeated key, one that failed."""
    at = scratch_path(spark, "validated")
    rows = _nations(spark, sf_dir).select(F.col("n_regionkey").alias("region"), _n().alias("k"))
    stored = rows.withColumn("k", F.when(F.col("region") == 2, 0).otherwise(F.col("k")).cast(rows.schema["k"].dataType))
    sinks.write_partitioned(stored, at, ["region"])
    manifests = sinks.manifest(rows, ["region"]).withColumns({"row_count": F.col("row_count") + F.when(F.col("region") == 1, 1).otherwise(0), "status": F.when(F.col("region") == 3, "failed").otherwise(F.col("status"))})
    found = sinks.validate(spark, at, manifests.withColumn("region", F.col("region").cast("int")), stored.schema, ["region"], ["k"])
    return found.select(F.col("region").cast("long").alias("region"), F.array_join("problems", ";").alias("problems"))


@query("""SELECT month(o_orderdate) AS month, o_orderkey, o_totalprice FROM orders""")
def log_finalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log appended to by a run, and again by its repetition; a month's file has each key once."""
    log, at = scratch_path(spark, "log"), scratch_path(spark, "month")
    rows = table(spark, sf_dir, "orders").select(F.month("o_orderdate").alias("month"), "o_orderkey", F.lit(1).alias("attempt"), "o_totalprice")
    sinks.append_log(rows.where("o_orderkey % 3 = 0").withColumn("o_totalprice", F.lit(0.0)), log)
    sinks.append_log(rows.withColumn("attempt", F.lit(2)), log)
    done = sinks.finalised(sinks.read_log(spark, log, rows.schema), "month", ["o_orderkey"], ["attempt"])
    sinks.write_partitioned(done, at, ["month"])
    return spark.read.parquet(at).select("month", "o_orderkey", "o_totalprice")


@query("""SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE p_name END AS value, CASE WHEN p_partkey % 2 = 0 THEN CAST(p_size AS DOUBLE) END AS value_num FROM part""")
def mixed_values_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column of numbers and text, stored as text with its number beside it, in one file."""
    at = scratch_path(spark, "mixed")
    mixed: Column = F.when(F.col("p_partkey") % 2 == 0, F.col("p_size").cast("string")).otherwise(F.col("p_name"))
    sinks.write_single(sinks.safe_text(table(spark, sf_dir, "part").select("p_partkey", mixed.alias("value")), "value", "value_num"), at)
    return spark.read.parquet(at)
