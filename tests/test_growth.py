"""Work that must grow no faster than the input: what plans hold, and how often rows are worked out."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from isobar import catalog
from isobar.operators import order_stats, stencil
from isobar.sources import market

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_passes_of_a_selection_do_not_work_out_its_values_again(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(x: int) -> float:
        seen.add(1)
        return float(x)

    x = F.udf(count, "double").asNondeterministic()("id")
    df = spark.range(3000).select((F.col("id") % 2).alias("g"), x.alias("x"))
    got = {r.g: r.q for r in order_stats.quantiles(df, ["g"], {"q": F.col("x")}, {"q": [0.0, 0.5]}, buffer_rows=10).collect()}
    assert got == {0: [0.0, 1499.0], 1: [1.0, 1500.0]} and seen.value == 3000


def test_joined_rows_are_worked_out_once_for_all_figures_of_errors(spark):
    assert "parquet" in optimized(catalog.QUERIES["issue_error_summary"](spark, SF)) and "Join" not in optimized(catalog.QUERIES["issue_error_summary"](spark, SF))


def test_a_label_is_read_in_one_place_of_the_plan(spark):
    docs = spark.createDataFrame([(1, '{"markets":[{"title":"x","name":"60-62"},{"title":"60-62"},{"outcomes":"[\\"no\\",\\"63+\\"]"}]}')], "event int, text string")
    found = market.event_bins(docs, "text", ["event"])
    assert optimized(found).count("regexp_extract_all") == 1
    assert sorted(tuple(r) for r in found.collect()) == [(1, "60-62", 60, 62), (1, "63+", 63, None)]


def test_a_sketch_is_kept_for_a_station_and_not_for_each_of_its_values(spark):
    plan = catalog.QUERIES["approximate_distinct"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and not any("approx_count_distinct" in line and "keys=[station" in line and "k#" in line.split("functions=")[0] for line in plan.splitlines())


def test_predictions_are_made_once_for_fits_and_appliers(spark):
    assert "get_json_object" not in optimized(catalog.QUERIES["segmented_offsets_applied"](spark, SF)) and "user_id" not in optimized(catalog.QUERIES["segmented_offsets_applied"](spark, SF))


def test_a_place_is_searched_for_once_however_many_points_it_has(spark):
    cells = spark.createDataFrame([(0, 0, 10.0, 10.0), (0, 1, 10.0, 11.0)], "row int, col int, lat double, lon double")
    points = spark.createDataFrame([(1, 10.1, 10.2), (2, 10.1, 10.2), (3, 10.0, 30.0), (4, None, 10.0)], "k int, lat double, lon double")
    found = stencil.nearest_cell(cells, points, ["k"])
    assert "Aggregate [lat" in optimized(found)
    assert {r.k: (r.row, r.col) for r in found.collect()} == {1: (0, 0), 2: (0, 0), 3: (0, 1), 4: (None, None)}


def test_keys_with_few_rows_are_called_once_and_not_once_a_batch(spark, tmp_path):
    from isobar.streaming import streams

    rows = spark.range(400).select((F.col("id") % 100).alias("k"), F.timestamp_seconds("id").alias("ts"))
    few = streams.in_time_order(rows, "ts", f"{tmp_path}/few", 50, "ts", "k")[1]
    hot = streams.in_time_order(rows, "ts", f"{tmp_path}/hot", 3, "ts", "k")[1]
    assert few >= 9 and hot == 1
