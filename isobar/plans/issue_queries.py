"""Forecast issues: orders as issues (station = customer, time = order date), line items as their valid times; and joins."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.functions.parse import event_bin
from isobar.operators import asof, select, summarize
from isobar.plans.registry import OBS, observations, query, table

YEARS = tuple(range(1996, 2002))
_spine = f"spine AS (SELECT c_custkey AS station, y AS year, make_date(y, 1, 1) + INTERVAL 5 MINUTE AS cutoff FROM customer, (SELECT unnest({list(YEARS)}) AS y))"
_latest = f"""{_spine},
issues AS (SELECT *, lag(o_orderkey) OVER w AS previous_key, lag(o_totalprice) OVER w AS previous_price FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)),
found AS (SELECT s.station, s.year, s.cutoff, i.*, row_number() OVER (PARTITION BY s.station, s.year ORDER BY i.o_orderdate DESC, i.o_orderkey DESC) AS r FROM spine s LEFT JOIN issues i ON i.o_custkey = s.station AND i.o_orderdate <= s.cutoff)"""


def issue_spine(spark: SparkSession, sf_dir: str) -> DataFrame:
    stations = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("station"), F.explode(F.array(*map(F.lit, YEARS))).alias("year"))
    return stations.withColumn("cutoff", F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp_ntz") + F.expr("INTERVAL 5 MINUTES"))


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    issues = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "station").withColumnRenamed("o_orderkey", "key").withColumnRenamed("o_totalprice", "price").withColumn("issue_key", F.col("key"))
    return asof.latest_issues(issues, issue_spine(spark, sf_dir), ["station"], "o_orderdate", "cutoff", ["issue_key", "price"], ["key"])


@query(f"WITH {_latest} SELECT station, year, o_orderkey AS latest_key, previous_key FROM found WHERE r = 1")
def latest_and_previous_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).select("station", "year", F.col("latest_issue_key").alias("latest_key"), F.col("previous_issue_key").alias("previous_key"))


@query(f"WITH {_latest} SELECT station, year, o_totalprice AS latest_price, round(o_totalprice - previous_price, 6) AS price_revision FROM found WHERE r = 1")
def issue_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest(spark, sf_dir).select("station", "year", "latest_price", F.round(F.col("latest_price") - F.col("previous_price"), 6).alias("price_revision"))


@query("""WITH c AS (SELECT l_suppkey AS supplier, year(l_shipdate) AS year, CAST(l_linenumber AS BIGINT) AS cycle, count(DISTINCT month(l_shipdate)) AS covered FROM lineitem GROUP BY ALL)
SELECT supplier, CAST(year AS BIGINT) AS year, cycle, covered, covered >= 12 AS full_coverage FROM c
QUALIFY row_number() OVER (PARTITION BY supplier, year ORDER BY covered >= 12 DESC, CASE WHEN covered >= 12 THEN 0 ELSE -covered END, cycle) = 1""")
def anchor_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("supplier"), F.year("l_shipdate").cast("long").alias("year"), F.col("l_linenumber").cast("long").alias("cycle"), F.month("l_shipdate").alias("slot"))
    return summarize.anchor_cycle(rows, ["supplier", "year"], "cycle", "slot", F.col("cycle"), 12)


@query("""WITH e AS (SELECT o_orderkey AS cycle, o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER)) AS init, unnest(range(0, 49, 3)) AS lead, o_orderdate FROM orders),
v AS (SELECT *, init + to_hours(CAST(lead AS INTEGER)) AS valid FROM e)
SELECT cycle, count(*) AS n_slots, CAST(min(hour(valid)) AS BIGINT) AS first_hour, CAST(max(hour(valid)) AS BIGINT) AS last_hour, CAST(min(lead) AS BIGINT) AS first_lead FROM v
WHERE CAST(valid AS DATE) = CAST(o_orderdate AS DATE) + 1 AND hour(valid) <= 21 GROUP BY cycle""")
def valid_hour_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    init = F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cycle"), "o_orderdate", init.alias("init"), F.explode(F.sequence(F.lit(0), F.lit(48), F.lit(3))).alias("lead"))
    rows = rows.withColumn("valid", F.col("init") + F.make_dt_interval(hours=F.col("lead")))
    inside = rows.where((F.col("valid").cast("date") == F.date_add(F.col("o_orderdate").cast("date"), 1)) & (F.hour("valid") <= 21))
    return inside.groupBy("cycle").agg(F.count("*").alias("n_slots"), F.min(F.hour("valid")).cast("long").alias("first_hour"), F.max(F.hour("valid")).cast("long").alias("last_hour"), F.min("lead").cast("long").alias("first_lead"))


@query("""SELECT o_orderkey AS cycle, CAST(o_orderdate AS DATE) AS issued, CASE WHEN o_orderkey % 4 = 0 THEN 48 ELSE 18 END AS horizon_hours,
    (SELECT count(*) FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_shipdate > o.o_orderdate AND l.l_shipdate <= o.o_orderdate + INTERVAL 90 DAY) AS n_valid FROM orders o""")
def eligible_forecasts(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("cycle"), "o_orderdate")
    items = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("cycle"), "l_shipdate")
    d = F.col("o_orderdate")
    inside = orders.join(items, "cycle").where((F.col("l_shipdate") > d) & (F.col("l_shipdate") <= d + F.expr("INTERVAL 90 DAYS"))).groupBy("cycle").agg(F.count("*").alias("n"))
    return orders.join(inside, "cycle", "left").select("cycle", d.cast("date").alias("issued"), F.when(F.col("cycle") % 4 == 0, 48).otherwise(18).alias("horizon_hours"), F.coalesce("n", F.lit(0).cast("long")).alias("n_valid"))


@query("""SELECT l_orderkey, l_partkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) = 1""")
def dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]
    return summarize.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey"], order).select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("""SELECT l_orderkey, l_returnflag, l_shipdate::DATE AS shipped, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE l_returnflag WHEN 'R' THEN 0 WHEN 'A' THEN 1 ELSE 2 END, l_shipdate DESC, l_extendedprice DESC, l_partkey) = 1""")
def dedup_keep_last_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    priority = F.when(F.col("l_returnflag") == "R", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2)
    found = summarize.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey"], [priority, F.desc("l_shipdate"), F.desc("l_extendedprice"), F.col("l_partkey")])
    return found.select("l_orderkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("shipped"), "l_extendedprice")


@query("""WITH f AS (SELECT l_suppkey, l_orderkey, l_linenumber, l_partkey, l_extendedprice AS price, l_quantity AS size,
    coalesce(sum(l_quantity) OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM (SELECT * FROM lineitem QUALIFY l_extendedprice >= max(l_extendedprice) OVER (PARTITION BY l_suppkey) - 20000))
SELECT l_suppkey, count(*) AS offers, sum(least(size, 200 - before)) AS filled, round(sum(least(size, 200 - before) * price) / sum(least(size, 200 - before)) + 1e-7, 4) AS average_price FROM f WHERE before < 200 GROUP BY l_suppkey""")
def order_book_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    taken = select.running_take(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice", "l_quantity", 200.0, 20000.0, ["l_orderkey", "l_linenumber", "l_partkey"])
    return taken.groupBy("l_suppkey").agg(F.count("*").alias("offers"), F.sum("filled").alias("filled"), F.round(F.sum(F.col("filled") * F.col("l_extendedprice")) / F.sum("filled") + 1e-7, 4).alias("average_price"))


TYPES = ("PROMO", "STANDARD", "ECONOMY")


@query(f"""SELECT p_brand, p_partkey, p_type, CAST(list_position({list(TYPES)}, p_type) AS BIGINT) AS preference FROM part WHERE p_type IN {TYPES}
QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY list_position({list(TYPES)}, p_type), p_retailprice DESC, p_partkey) = 1""")
def preference_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = select.preferred(table(spark, sf_dir, "part"), ["p_brand"], "p_type", TYPES, [F.desc("p_retailprice"), "p_partkey"])
    return found.select("p_brand", "p_partkey", "p_type", F.col("preference").cast("long").alias("preference"))


@query("""SELECT o_orderkey FROM orders SEMI JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_returnflag = 'R') k ON o_orderkey = l_orderkey""")
def semi_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'").select("l_orderkey").distinct()
    orders = table(spark, sf_dir, "orders")
    return orders.join(keys, orders["o_orderkey"] == keys["l_orderkey"], "left_semi").select("o_orderkey")


@query("""SELECT c_custkey, c_name FROM customer ANTI JOIN orders ON c_custkey = o_custkey""")
def anti_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers, orders = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    return customers.join(orders, customers["c_custkey"] == orders["o_custkey"], "left_anti").select("c_custkey", "c_name")


_price_bins = "(VALUES ('low', NULL, 100000), ('middle', 100001, 300000), ('high', 300001, NULL)) b(name, lower, upper)"


@query(f"""SELECT name, count(*) AS n, CAST(count(DISTINCT o_custkey) AS BIGINT) AS stations FROM orders, {_price_bins}
WHERE (lower IS NULL OR round(o_totalprice) >= lower) AND (upper IS NULL OR round(o_totalprice) <= upper) GROUP BY name""")
def theta_bin_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    bins = spark.createDataFrame([("low", None, 100000), ("middle", 100001, 300000), ("high", 300001, None)], "name string, lower int, upper int")
    price = F.round("o_totalprice")
    inside = (F.col("lower").isNull() | (price >= F.col("lower"))) & (F.col("upper").isNull() | (price <= F.col("upper")))
    return table(spark, sf_dir, "orders").join(F.broadcast(bins), inside).groupBy("name").agg(F.count("*").alias("n"), F.countDistinct("o_custkey").alias("stations"))


@query("""WITH s AS (SELECT l_suppkey, l_shipdate, l_extendedprice - o_totalprice / 7 AS e FROM lineitem JOIN orders ON l_orderkey = o_orderkey)
SELECT CAST(month(l_shipdate) AS BIGINT) AS issue_month, count(*) AS n, round(avg(abs(e)), 4) AS mae, round(sqrt(avg(e * e)), 4) AS rmse, round(avg(e), 4) AS bias, round(quantile_cont(abs(e), 0.5), 4) AS median_abs_error,
    round(quantile_cont(abs(e), 0.75), 4) AS p75_abs_error, round(avg(CASE WHEN abs(e) <= 1 THEN 1.0 ELSE 0 END), 6) AS within_1, round(avg(CASE WHEN abs(e) <= 2 THEN 1.0 ELSE 0 END), 6) AS within_2
FROM s GROUP BY 1 ORDER BY mae, n DESC LIMIT 12""")
def issue_error_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isobar.operators.scoring import error_summary

    items, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    joined = items.join(orders, items["l_orderkey"] == orders["o_orderkey"])
    found = error_summary(joined.withColumn("issue_month", F.month("l_shipdate").cast("long")), ["issue_month"], F.col("o_totalprice") / 7, F.col("l_extendedprice"))
    found = found.withColumns({c: F.round(c, 4) for c in ("mae", "rmse", "bias", "median_abs_error", "p75_abs_error")} | {c: F.round(c, 6) for c in ("within_1", "within_2")})
    return found.orderBy("mae", F.desc("n")).limit(12)


#: Forms of labels (a number, or one and that plus three), and how far their bounds are from the number; worked out by hand.
LABELS = [
    ("{} or below", None, 0), ("{}-{}", 0, 3), ("{}+", 0, None), ("under {}", None, -1), ("above {}", 1, None), ("{1} to {0}", 0, 3), ("{}", 0, 0), ("{}° or higher", 0, None), ("less than {}", None, -1), ("{}°F or lower", None, 0),
    ("abc", None, None), ("{} through {}", 0, 3), ("{} degrees or higher", 0, None), ("{} and above", 0, None), ("{}F above", 0, None), ("{} below", None, -1), ("{} and below", None, -1), ("{} lower", None, 0), ("{}F or under", None, 0),
    ("greater than {}", 1, None), ("{}-{}°F", 0, 3), ("{}F", 0, 0), ("between {} and {}", None, None), ("  {}  ", 0, 0), ("Will it be {} degrees or below?", None, 0),
]


def _label_sql(form: str) -> str:
    parts = re.split(r"(\{[01]?\})", form)
    numbers = iter(("n", "n + 3"))
    pieces = [{"{0}": "n", "{1}": "n + 3", "{}": None}.get(p, "'" + p + "'") or next(numbers) for p in parts if p]
    return " || ".join(f"CAST({p} AS VARCHAR)" if p[0] == "n" else p for p in pieces)


@query("WITH p AS (SELECT p_partkey, p_partkey % 110 AS n FROM part), f AS (" + " UNION ALL ".join(
    f"SELECT p_partkey, {_label_sql(form)} AS label, {'CAST(NULL AS BIGINT)' if a is None else f'n + {a}'} AS lower, {'CAST(NULL AS BIGINT)' if b is None else f'n + {b}'} AS upper FROM p WHERE p_partkey % {len(LABELS)} = {k}" for k, (form, a, b) in enumerate(LABELS)
) + ") SELECT p_partkey, label, CAST(lower AS INTEGER) AS lower, CAST(upper AS INTEGER) AS upper FROM f")
def event_bin_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part").select("p_partkey", (F.col("p_partkey") % 110).alias("n"))
    label = F.lit(None).cast("string")
    for k, (form, _, _) in enumerate(LABELS):
        label = F.when(F.col("p_partkey") % len(LABELS) == k, F.expr(_label_sql(form).replace("VARCHAR", "STRING"))).otherwise(label)
    parsed = event_bin(F.col("label"))
    return part.select("p_partkey", label.alias("label")).select("p_partkey", "label", parsed["lower"].alias("lower"), parsed["upper"].alias("upper"))


@query("""WITH p AS (SELECT page_id, url, regexp_extract(url, '^[a-z]+://([^/?#]+)', 1) AS host FROM pages)
SELECT host, count(*) AS n, CAST(min(page_id) AS BIGINT) AS first_page FROM p GROUP BY host""")
def host_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").groupBy(F.regexp_extract("url", "^[a-z]+://([^/?#]+)", 1).alias("host")).agg(F.count("*").alias("n"), F.min("page_id").alias("first_page"))


@query("""SELECT o_orderkey AS record, o_orderkey * 100 AS "offset", strftime(o_orderdate, '%Y%m%d') || '00' AS init, 'TMP' AS short, (o_orderkey % 48) || ' hour fcst' AS step,
    lead(o_orderkey * 100) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - o_orderkey * 100 AS length FROM orders""")
def inventory_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    from isobar.sources.text import inventory

    k = F.col("o_orderkey")
    line = F.concat(k.cast("string"), F.lit(":"), (k * 100).cast("string"), F.lit(":d="), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("00:TMP:2 m above ground:"), (k % 48).cast("string"), F.lit(" hour fcst:"))
    lines = table(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("source_path"), line.alias("line"))
    return inventory(lines).select("record", "offset", "init", "short", "step", "length")


@query(f"""WITH {OBS}, d AS (SELECT station, date_local, max(value) AS tmax FROM obs GROUP BY ALL)
SELECT station, count(*) AS n FROM (SELECT station, date_local FROM obs WHERE event_type = 'click' INTERSECT SELECT station, date_local FROM obs WHERE event_type = 'view') GROUP BY station""")
def slot_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    def days(kind: str) -> DataFrame:
        return obs.where(F.col("event_type") == kind).select("station", "date_local")

    return days("click").intersect(days("view")).groupBy("station").agg(F.count("*").alias("n"))


@query(f"""WITH {OBS} SELECT station, date_local FROM obs WHERE event_type = 'click' EXCEPT SELECT station, date_local FROM obs WHERE event_type = 'error'""")
def slot_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = observations(spark, sf_dir)
    return obs.where("event_type = 'click'").select("station", "date_local").subtract(obs.where("event_type = 'error'").select("station", "date_local"))


@query("""SELECT n_name, c_mktsegment, count(*) AS n, round(sum(o_totalprice), 2) AS total, CAST(grouping(n_name, c_mktsegment) AS BIGINT) AS level FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY CUBE (n_name, c_mktsegment)""")
def dimension_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, customer, nation = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(nation, customer["c_nationkey"] == nation["n_nationkey"])
    return joined.cube("n_name", "c_mktsegment").agg(F.count("*").alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.grouping_id().cast("long").alias("level"))


@query("""SELECT c_nationkey, c_custkey, CAST(rank() OVER w AS BIGINT) AS rank_min, CAST(dense_rank() OVER w AS BIGINT) AS rank_dense, CAST(ntile(4) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS BIGINT) AS quartile FROM customer WINDOW w AS (PARTITION BY c_nationkey ORDER BY c_acctbal DESC)""")
def ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("c_nationkey").orderBy(F.desc("c_acctbal"))
    return table(spark, sf_dir, "customer").select("c_nationkey", "c_custkey", F.rank().over(w).cast("long").alias("rank_min"), F.dense_rank().over(w).cast("long").alias("rank_dense"), F.ntile(4).over(w.orderBy(F.desc("c_acctbal"), "c_custkey")).cast("long").alias("quartile"))


@query("""WITH o AS (SELECT o_custkey, o_orderdate AS opened, max(l_shipdate) AS shipped FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_custkey, o_orderdate),
w AS (SELECT DISTINCT o_custkey, year(o_orderdate) AS y FROM orders), d AS (SELECT o_custkey, y, CAST(make_date(y, 1, 1) AS DATE) AS a, CAST(make_date(y, 12, 31) AS DATE) AS z FROM w)
SELECT d.o_custkey, CAST(d.y AS INTEGER) AS y, count(*) AS n, CAST(sum(date_diff('day', greatest(opened, a), least(shipped, z)) + 1) AS BIGINT) AS covered FROM d JOIN o ON o.o_custkey = d.o_custkey AND opened <= z AND shipped >= a AND opened <= shipped GROUP BY 1, 2""")
def interval_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of a customer's orders were open in each of the years in which it ordered, and for how many days."""
    from isobar.operators.intervals import overlaps

    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    opened = orders.join(items, orders["o_orderkey"] == items["l_orderkey"]).groupBy("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("opened")).agg(F.max(F.col("l_shipdate").cast("date")).alias("shipped"))
    years = orders.select("o_custkey", F.year("o_orderdate").alias("y")).distinct().select("o_custkey", "y", F.make_date("y", F.lit(1), F.lit(1)).alias("a"), F.make_date("y", F.lit(12), F.lit(31)).alias("z"))
    found = overlaps(years, opened, ["o_custkey"], ("a", "z"), ("opened", "shipped"))
    return found.groupBy("left.o_custkey", "left.y").agg(F.count("*").alias("n"), F.sum("covered").alias("covered"))
