"""Streams over events, run over what is there and read back; each equals a batch query."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.plans.registry import query, table
from isobar.session import scratch_path
from isobar.streaming import leases, polling, streams


#: Events of one batch where a batch's rows of one key are held at once.
BATCH_ROWS = 2_000_000


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a stream, a file a batch; the table is one file or a folder of them."""
    path = f"{sf_dir}/events.parquet"
    schema = table(spark, sf_dir, "events").schema
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    is_file = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(hadoop).isFile()
    rows = streams.stream_table(spark, sf_dir if is_file else path, schema, glob="events.parquet" if is_file else None)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _run(spark: SparkSession, stream: DataFrame, mode: str) -> DataFrame:
    """All that the stream appends."""
    at = scratch_path(spark, "stream")
    streams.drain(stream, f"{at}/out", f"{at}/state", mode)
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def _ordered(spark: SparkSession, sf_dir: str, at: str, closing: str | None = None, prepare: Callable[[DataFrame], DataFrame] = lambda events: events, key: str | None = None) -> DataFrame:
    """events as a stream in order of time."""
    events = prepare(table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp")))
    folder, files = streams.in_time_order(events, "ts", f"{at}/events", BATCH_ROWS, closing, key)
    return streams.stream_table(spark, folder, events.schema, files_per_batch=files)


def _closed(spark: SparkSession, sf_dir: str, make: Callable[[DataFrame], DataFrame], prepare: Callable[[DataFrame], DataFrame] = lambda events: events, key: str | None = None) -> DataFrame:
    """What ``make``, with a watermark, has appended when every window of the events has closed, in one run.

    Events come by time; one event far behind them all moves the watermark past
    their windows, and its own window stays open. State is what the watermark
    has not passed.
    """
    at = scratch_path(spark, "stream")
    found = make(_ordered(spark, sf_dir, at, "ts", prepare, key))
    streams.drain(found, f"{at}/out", f"{at}/state")
    return spark.read.schema(found.schema).parquet(f"{at}/out")


def _micros(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.unix_micros(F.col(n).cast("timestamp")) for n in names}).withColumnsRenamed({n: f"{n}_us" for n in names})


def _aggregates() -> list[Column]:
    return [F.count("*").alias("n"), F.max("value").alias("most")]


_hour, _six = 3_600_000_000, 6 * 3_600_000_000


@query(f"""SELECT (epoch_us(ts) // {_hour}) * {_hour} AS window_start_us, (epoch_us(ts) // {_hour} + 1) * {_hour} AS window_end_us, event_type, count(*) AS n, max(value) AS most FROM events GROUP BY ALL""")
def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _closed(spark, sf_dir, lambda events: streams.windowed(events, "ts", "1 hour", _aggregates(), ["event_type"], late="1 hour"))
    return _micros(found, "window_start", "window_end")


@query(f"""WITH w AS (SELECT *, unnest(range(0, 6)) AS i FROM events) SELECT (epoch_us(ts) // {_hour} - i) * {_hour} AS window_start_us, (epoch_us(ts) // {_hour} - i) * {_hour} + {_six} AS window_end_us, event_type, count(*) AS n, max(value) AS most FROM w GROUP BY ALL""")
def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _closed(spark, sf_dir, lambda events: streams.windowed(events, "ts", "6 hours", _aggregates(), ["event_type"], slide="1 hour", late="1 hour"))
    return _micros(found, "window_start", "window_end")


@query("""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 2 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, epoch_us(min(ts)) AS session_start_us, epoch_us(max(ts)) + 7200000000 AS session_end_us, count(*) AS n, max(value) AS most FROM s GROUP BY user_id, session""")
def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _closed(spark, sf_dir, lambda events: streams.sessions(events, "ts", "2 hours", _aggregates(), ["user_id"], late="1 hour"))
    return _micros(found, "session_start", "session_end")


@query(f"""WITH w AS (SELECT (epoch_us(ts) // {_six} + 1) * {_six} AS window_end_us, * FROM events) SELECT window_end_us - {_six} AS window_start_us, window_end_us, event_type, count(*) AS n, max(value) AS most FROM w
WHERE window_end_us <= (SELECT epoch_us(max(ts)) // 1000 * 1000 - 86400000000 FROM events) GROUP BY ALL""")
def stream_late_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append mode: only windows that the watermark, a day behind the newest event, has closed."""
    found = streams.windowed(_events(spark, sf_dir), "ts", "6 hours", _aggregates(), ["event_type"], late="1 day")
    return _micros(_run(spark, found, "append"), "window_start", "window_end")


@query("""SELECT user_id AS key, epoch_us(ts) AS at, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events""")
def stateful_previous_issue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events are landed by time, whatever files they come in, so that none is late."""
    at = scratch_path(spark, "stream")
    found = streams.previous_issue(_ordered(spark, sf_dir, at, key="user_id"), "user_id", "ts", "value")
    streams.drain(found, f"{at}/out", f"{at}/state")
    return spark.read.schema("key long, at long, value double, previous double").parquet(f"{at}/out")


@query("""SELECT user_id, CAST(ts AS DATE) AS day, max(value) AS max_so_far, count(value) AS n FROM events GROUP BY ALL""")
def stream_running_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A day's maximum is final when the watermark has passed the day; until then its state is what came so far."""
    found = _closed(spark, sf_dir, lambda events: streams.running_max(events.withWatermark("ts", "1 hour"), [F.window("ts", "1 day"), "user_id"], "value"))
    return found.select("user_id", F.to_date("window.start").alias("day"), "max_so_far", "n")


LEASE_HOURS, BUDGET = 6, 3
_kinds = "CASE event_type WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'failed' ELSE 'beat' END"


@query(f"""WITH e AS (SELECT user_id, event_id, ts, {_kinds} AS kind FROM events),
f AS (SELECT *, CASE WHEN lag(kind) OVER w = 'beat' AND ts - lag(ts) OVER w < INTERVAL {LEASE_HOURS} HOUR THEN 0 ELSE 1 END AS fresh FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
l AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS lease FROM f),
a AS (SELECT user_id, lease, min(ts) AS leased_at, max(ts) AS last_at, count(*) AS beats, arg_max(kind, (ts, event_id)) AS kind FROM l GROUP BY ALL),
d AS (SELECT *, lease - coalesce(max(CASE WHEN kind = 'done' THEN lease END) OVER (PARTITION BY user_id ORDER BY lease ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS attempt FROM a),
x AS (SELECT *, coalesce(max(CASE WHEN attempt = {BUDGET} AND kind <> 'done' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY lease ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS over_budget FROM d)
SELECT user_id AS task, epoch_us(leased_at) AS leased_at, epoch_us(CASE WHEN kind = 'beat' THEN last_at + INTERVAL {LEASE_HOURS} HOUR ELSE last_at END) AS ended_at, CAST(beats AS BIGINT) AS beats, CAST(attempt AS BIGINT) AS attempt,
    CASE WHEN over_budget = 0 THEN CASE WHEN kind = 'beat' THEN 'expired' ELSE kind END END AS status FROM x WHERE over_budget = 0""")
def lease_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's events as the log of a task: any takes the lease or renews it, a purchase finishes it, an error gives it back; what is not renewed expires, and after three leases without success the task is left alone."""
    kind = F.when(F.col("event_type") == "purchase", "done").when(F.col("event_type") == "error", "failed").otherwise("beat")
    log = lambda events: leases.states(events.select("user_id", "event_id", "ts", kind.alias("kind")), "user_id", "ts", "event_id", "kind", LEASE_HOURS, BUDGET, late="1 hour")
    return _closed(spark, sf_dir, log, key="user_id")


POLL_MINUTES = 720
_poll = POLL_MINUTES * 60_000_000


@query(f"""SELECT event_id, epoch_us(ts) AS at, (epoch_us(ts) // {_poll} + 1) * {_poll} AS received_at, (epoch_us(ts) // {_poll} + 1) * {_poll} - epoch_us(ts) AS latency FROM events""")
def polled_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """When a feed that is asked twice a day first sees each event, and how late."""
    at = scratch_path(spark, "polled")
    polling.land(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", POLL_MINUTES, f"{at}/feed")
    found = polling.received(polling.poll(spark, f"{at}/feed", "event_id long, ts timestamp", POLL_MINUTES), "ts")
    streams.drain(found.select("event_id", "at", "received_at", "latency"), f"{at}/out", f"{at}/state")
    return spark.read.schema("event_id long, at long, received_at long, latency long").parquet(f"{at}/out")
