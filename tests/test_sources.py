"""Scans, sinks and streams on literal files."""

from __future__ import annotations

import datetime as dt
import gzip
import io
import json
import tarfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.operators import folds
from isobar.plans import contracts, stream_queries
from isobar.sources import market, observations, sinks, tables, text
from isobar.streaming import streams


def test_observation_documents(spark, tmp_path):
    day = {"metadata": {"status_code": 200}, "observations": [{"valid_time_gmt": 1678602600, "temp": 50, "gust": None, "precip_hrly": 0.1, "clds": "OVC"}, {"valid_time_gmt": 1678606200, "temp": 52, "clds": "CLR"}]}
    (tmp_path / "KLGA_9_US_2023-03-12.json").write_text(json.dumps(day))
    (tmp_path / "KLGA_9_US_2023-03-13.json").write_text(json.dumps({"metadata": {"status_code": 500}, "observations": []}))
    (tmp_path / "other.json").write_text("{}")
    docs = observations.documents(spark, str(tmp_path), "KLGA_9_US_*.json")
    rows = observations.observations(docs, "KLGA").orderBy("valid_time_utc").collect()
    assert [(r.valid_time_local, r.temp_f, r.wind_gust_mph, r.source_file) for r in rows] == [(dt.datetime(2023, 3, 12, 1, 30), 50.0, None, "KLGA_9_US_2023-03-12.json"), (dt.datetime(2023, 3, 12, 3, 30), 52.0, None, "KLGA_9_US_2023-03-12.json")]
    bad = {r.source_file: r for r in observations.file_quality(docs).collect()}
    assert bad["KLGA_9_US_2023-03-13.json"].bad_status and bad["KLGA_9_US_2023-03-13.json"].obs_count == 0 and not bad["KLGA_9_US_2023-03-12.json"].unsorted
    assert observations.documents(spark, str(tmp_path), "none_*.json").count() == 3


SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.DoubleType())])


def test_optional_named_and_conformed_scans(spark, tmp_path):
    assert tables.optional_parquet(spark, f"{tmp_path}/none", SCHEMA).count() == 0
    spark.createDataFrame([(1, float("nan"), "x")], "a int, b double, c string").write.parquet(f"{tmp_path}/t")
    assert tables.optional_parquet(spark, f"{tmp_path}/t", SCHEMA).collect() == [(1, None)]
    for k, frame in enumerate((spark.createDataFrame([(1,)], "a long"), spark.createDataFrame([(2, 0.5)], "a long, b double"))):
        frame.coalesce(1).write.parquet(f"{tmp_path}/many/date={k}/")
    found = tables.named_parquets(spark, f"{tmp_path}/many", "*.parquet", SCHEMA)
    assert sorted(map(tuple, found.collect())) == [(1, None), (2, 0.5)]
    assert {r.date for r in tables.with_partition_value(tables.named_parquets(spark, f"{tmp_path}/many", "*.parquet"), "date").collect()} == {"0", "1"}
    assert tables.union_by_name([spark.createDataFrame([(1,)], "a int"), spark.createDataFrame([("x",)], "b string")]).columns == ["a", "b"]


def test_issue_catalog(spark):
    rows = [("ok", "a.parquet; b.parquet", "2024-01-01T05:00:00Z", None), ("ok", "", "2024-01-01T05:00:00Z", "2024-01-01T06:00:00Z"), ("failed", "c", None, None), ("ok", "d", "bad", "bad")]
    found = tables.issue_catalog(spark.createDataFrame(rows, "extraction_status string, wide_output_paths string, init_time_utc string, processed_timestamp_utc string"))
    assert [(r.data_path, r.available_utc) for r in found.orderBy("data_path").collect()] == [("a.parquet", dt.datetime(2024, 1, 1, 5)), ("b.parquet", dt.datetime(2024, 1, 1, 5)), ("d", None)]


BULLETIN = """
 KLGA   GFS LAMP GUIDANCE   4/12/2026  0430 UTC
 UTC  05 06 07 23 00 01
 TMP  50 49999 48 -2  X
 WGS  NG 15 NG
 KJFK   GFS LAMP GUIDANCE   4/12/2026  0430 UTC
 UTC  05 06
 TMP  51 52
"""


def test_bulletin(spark, tmp_path):
    (tmp_path / "a.txt").write_text(BULLETIN)
    (tmp_path / "b.txt.gz").write_bytes(gzip.compress(BULLETIN.replace("KLGA", "KBOS").encode()))
    rows = text.bulletin_rows(text.whole_texts(spark, str(tmp_path)))
    assert {r.station for r in rows.select("station").distinct().collect()} == {"KLGA", "KJFK", "KBOS"}
    own = [(r.cell, r.token, r.value) for r in rows.where("station = 'KLGA' and label = 'TMP'").orderBy("cell").collect()]
    assert own == [(1, "50", 50.0), (2, "49", 49.0), (3, "999", None), (4, "48", 48.0), (5, "-2", -2.0), (6, "X", None)]
    hours = text.bulletin_hours(rows.where("station = 'KLGA'")).where("label = 'TMP'").orderBy("cell").collect()
    assert [r.forecast_hour for r in hours] == [1, 2, 3, 19, 20, 21] and hours[4].valid_utc == dt.datetime(2026, 4, 13, 0)


def test_inventory_and_archives(spark, tmp_path):
    lines = spark.createDataFrame([("f", "1:0:d=2024010100:TMP:2 m above ground:6 hour fcst:"), ("f", "2:500:d=2024010100:DPT:2 m above ground:6 hour fcst:ens std dev"), ("f", "nothing")], "source_path string, line string")
    found = text.inventory(lines, F.lit(900)).orderBy("record").collect()
    assert [(r.record, r.short, r.extra, r.length) for r in found] == [(1, "TMP", "", 500), (2, "DPT", "ens std dev", 400)]
    with tarfile.open(tmp_path / "a.tar.gz", "w:gz") as out:
        data = b"inside"
        info = tarfile.TarInfo("x.txt")
        info.size = len(data)
        out.addfile(info, io.BytesIO(data))
    (tmp_path / "broken.tar.gz").write_bytes(b"\x1f\x8bno")
    got = {r.source_path.rsplit("/", 1)[1]: r for r in text.archive_members(spark, str(tmp_path), "*.tar.gz").collect()}
    assert got["a.tar.gz"].text == "inside" and got["broken.tar.gz"].text is None and got["broken.tar.gz"].error


def test_market_bins(spark):
    doc = json.dumps({"markets": [{"groupItemTitle": "69-70°F"}, {"groupItemTitle": "?", "title": "71°F or higher"}, {"title": "x", "outcomes": '["No", "68°F or below"]'}, {"title": "69-70°F"}, {"title": "none"}]})
    found = market.event_bins(spark.createDataFrame([(1, doc), (2, None), (3, "{")], "e int, t string"), "t", ["e"]).orderBy(F.coalesce("lower", F.lit(0))).collect()
    assert [(r.name, r.lower, r.upper) for r in found] == [("68°F or below", None, 68), ("69-70°F", 69, 70), ("71°F or higher", 71, None)]


def test_partitioned_sink_replaces_only_its_days_and_is_validated(spark, tmp_path):
    path = f"{tmp_path}/out"
    first = spark.createDataFrame([("d1", 1, 1.0), ("d2", 1, 2.0)], "day string, k int, v double")
    sinks.write_partitioned(first, path, ["day"])
    sinks.write_partitioned(spark.createDataFrame([("d2", 1, 3.0), ("d2", 2, 4.0)], "day string, k int, v double"), path, ["day"], files=2)
    assert sorted((r.day, r.k, r.v) for r in spark.read.parquet(path).collect()) == [("d1", 1, 1.0), ("d2", 1, 3.0), ("d2", 2, 4.0)]
    bad = sinks.validate(spark, path, sinks.manifest(first, ["day"]), first.schema, ["day"], ["k"]).collect()
    assert [(r.day, list(r.problems)) for r in bad] == [("d2", ["row_count"])]


def test_contract_layout_and_audit(spark):
    schema = contracts.registry(contracts.column("date_local", "date", "identity"), contracts.column("label_x", "float64", "label"), contracts.column("nbm_ok", "bool", "feature"), contracts.column("wu_wind_ms", "float64", "feature"))
    df = contracts.layout(spark.createDataFrame([(dt.date(2024, 1, 1), 1, "gone")], "date_local date, label_x int, other string"), schema)
    assert df.columns == schema.names and df.first().nbm_ok is False
    report = contracts.audit(df.union(df), schema, ["date_local"]).first()
    assert (report.row_count, report.duplicate_keys, report.core_nulls, report.exact_layout, report.passed) == (2, 1, 2, True, False)
    assert contracts.audit(df, schema, ["date_local"]).first().passed and not contracts.audit(df.limit(0), schema, ["date_local"]).first().passed
    assert contracts.normalised_registry(schema)[-1] == ("wu_wind_ms", "ms_to_mph", "wu_wind_mph")
    assert contracts.feature_columns(df) == ["nbm_ok", "wu_wind_ms"]


def test_leaking_folds_are_refused(spark):
    with pytest.raises(ValueError):
        folds.rolling_origin(spark.range(1).withColumn("d", F.current_date()), "d", [("2024-01-02", "2024-01-02", "2024-01-03")])


def test_previous_issue_over_batches_drops_late_rows(spark, tmp_path):
    schema = "user_id long, ts timestamp, value double"
    def at(hour):
        return dt.datetime(2024, 1, 1, hour)

    for k, rows in enumerate(([(1, at(1), 1.0), (1, at(3), 3.0), (2, at(1), 9.0)], [(1, at(2), 2.0), (1, at(4), 4.0)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.stream_table(spark, f"{tmp_path}/in", T.StructType.fromDDL(schema))
        streams.drain(streams.previous_issue(stream, "user_id", "ts", "value"), f"{tmp_path}/out", f"{tmp_path}/state")
    found = spark.read.parquet(f"{tmp_path}/out").orderBy("key", "at").collect()
    assert [(r.key, r.value, r.previous) for r in found] == [(1, 1.0, None), (1, 3.0, 1.0), (1, 4.0, 3.0), (2, 9.0, None)]


def test_previous_issue_of_files_that_overlap_in_time(spark, tmp_path, monkeypatch):
    rows = [(i % 3, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), float(i)) for i in range(60)]
    for part in (rows[1::2], rows[0::2]):
        spark.createDataFrame(part, "user_id long, ts timestamp, value double").coalesce(1).write.mode("append").parquet(f"{tmp_path}/events.parquet")
    expected = sorted((k, v, v - 3 if v >= 3 else None) for k, _, v in rows)
    for batch_rows in (1000, 25):
        monkeypatch.setattr(stream_queries, "BATCH_ROWS", batch_rows)
        assert sorted((r.key, r.value, r.previous) for r in stream_queries.stateful_previous_issue(spark, str(tmp_path)).collect()) == expected
