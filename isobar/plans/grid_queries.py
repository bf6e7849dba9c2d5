"""Grids: packed messages, windows of tiles, stencils; snapshots and SQL functions. The grid is made from embeddings: a row a vector, a column a component."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.functions import sql as sql_functions
from isobar.operators import tiles
from isobar.plans.registry import ORACLES, query, table
from isobar.plans.source_queries import _bulletins
from isobar.session import scratch_path
from isobar.sources import packed, snapshots

GRID = T.StructType([T.StructField("row", T.LongType()), T.StructField("col", T.LongType()), T.StructField("value", T.DoubleType())])


def _grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    each = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("row"), F.posexplode("embedding").alias("col", "value"))
    return each.select("row", F.col("col").cast("long").alias("col"), F.col("value").cast("double").alias("value"))


_cells = "SELECT vec_id AS row, CAST(i - 1 AS BIGINT) AS col, embedding[i]::DOUBLE AS value FROM embeddings, range(1, 65) r(i)"


@query("""SELECT vec_id, CAST((i - 1) // 8 AS INTEGER) AS row, CAST((i - 1) % 8 AS INTEGER) AS col, floor(embedding[i]::DOUBLE * 1000 + 0.5) / 1000 AS value FROM embeddings, range(1, 65) r(i) WHERE abs(embedding[i]::DOUBLE) < 0.2""")
def packed_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector as a packed 8 by 8 grid, without its larger components, and what is unpacked from it: the value to three places."""
    grids = F.transform("embedding", lambda x: F.when(F.abs(x.cast("double")) < 0.2, x.cast("double")))
    messages = table(spark, sf_dir, "embeddings").select("vec_id", packed.packed(grids, 3).alias("message"))
    at = scratch_path(spark, "messages")
    messages.write.parquet(at)
    return packed.cells(spark.read.parquet(at), ["vec_id"], "message", 8)


_windows = "SELECT n_nationkey AS place, n_nationkey * 19 % 97 AS row0, n_nationkey * 19 % 97 + n_nationkey % 7 AS row1, n_nationkey * 5 % 60 AS col0, n_nationkey * 5 % 60 + n_regionkey AS col1 FROM nation"


@query(f"""WITH c AS ({_cells}), w AS ({_windows}) SELECT place, count(*) AS n, round(avg(value), 6) AS mean, min(value) AS least, max(value) AS most FROM w JOIN c ON row BETWEEN row0 AND row1 AND col BETWEEN col0 AND col1 GROUP BY place""")
def tile_window_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows around places, read from the tiles that they touch."""
    at = scratch_path(spark, "tiles")
    tiles.write_tiles(_grid(spark, sf_dir), at)
    n = F.col("n_nationkey").cast("long")
    windows = table(spark, sf_dir, "nation").select(n.alias("place"), (n * 19 % 97).alias("row0"), (n * 19 % 97 + n % 7).alias("row1"), (n * 5 % 60).alias("col0"), (n * 5 % 60 + F.col("n_regionkey")).alias("col1"))
    found = tiles.in_windows(spark, at, GRID, windows)
    return found.groupBy("place").agg(F.count("*").alias("n"), F.round(F.avg("value"), 6).alias("mean"), F.min("value").alias("least"), F.max("value").alias("most"))


@query(f"""WITH c AS ({_cells}) SELECT a.row, a.col, count(*) AS n, round(avg(b.value) + 1e-9, 5) AS mean, min(b.value) AS least, max(b.value) AS most, round(stddev_pop(b.value) + 1e-9, 5) AS std
FROM c a JOIN c b ON b.row BETWEEN a.row - 3 AND a.row + 3 AND b.col BETWEEN a.col - 3 AND a.col + 3 GROUP BY a.row, a.col""")
def cell_stencil_7x7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of every cell's neighbourhood, clipped at the edges."""
    found = tiles.stencil(_grid(spark, sf_dir), [], 3)
    return found.select("row", "col", "n", F.round(F.col("mean") + 1e-9, 5).alias("mean"), F.round("min", 12).alias("least"), F.round("max", 12).alias("most"), F.round(F.col("std") + 1e-9, 5).alias("std"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'P' ELSE o_orderstatus END AS status, o_totalprice, CAST(2 AS BIGINT) AS version FROM orders""")
def snapshot_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table committed twice; a third writer that has read the first version loses the race and changes nothing."""
    at = scratch_path(spark, "snapshots")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("status"), "o_totalprice")
    first = snapshots.commit(orders, at, based_on=0)
    changed = snapshots.read(spark, at).withColumn("status", F.when(F.col("o_orderkey") % 2 == 0, "P").otherwise(F.col("status")))
    snapshots.commit(changed, at, based_on=first)
    try:
        snapshots.commit(orders.limit(0), at, based_on=first)
    except snapshots.LostRace:
        pass
    return snapshots.read(spark, at).withColumn("version", F.lit(snapshots.manifest(spark, at)["version"]).cast("long"))


@query(ORACLES["bulletin_parse"])
def bulletin_lateral(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bulletins by SQL text: a lateral join with a table function."""
    sql_functions.register(spark)
    _bulletins(spark, sf_dir).createOrReplaceTempView("bulletins")
    return spark.sql("SELECT c.station, c.label, c.forecast_hour, c.valid_utc, c.token, c.value FROM bulletins, LATERAL bulletin_cells(text) AS c")


@query("""SELECT event_id, round((value + 200 - 273.15) * 9 / 5 + 32, 6) AS f, CAST(floor(value * 9 / 5 + 32.5) AS INTEGER) AS whole, round(value * 2.2369362920544, 6) AS mph, CASE WHEN value * 2 > 180 THEN round(value * 2 - 360, 6) ELSE round(value * 2, 6) END AS lon,
    CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS day, round(greatest(0.9 * (value - 50), -0.1 * (value - 50)), 6) AS loss FROM events WHERE value IS NOT NULL""")
def sql_scalars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered functions in SQL text."""
    sql_functions.register(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("event_rows")
    return spark.sql("""SELECT event_id, round(kelvin_to_f(value + 200), 6) AS f, whole_f(value) AS whole, round(mps_to_mph(value), 6) AS mph, round(longitude_180(value * 2), 6) AS lon, local_day(ts, 'America/New_York') AS day,
        round(pinball(value, 50, 0.9), 6) AS loss FROM event_rows WHERE value IS NOT NULL""")
