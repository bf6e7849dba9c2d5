"""Streaming forms of the time-series operators, and their batch equals.

Late data: an event counts if it is not older than the watermark. Every
function takes a streaming or a batch frame, except where it says so.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def windowed(events: DataFrame, time: str, width: str, aggregates: list[Column], by: list[Column | str], slide: str | None = None, late: str | None = None) -> DataFrame:
    """Tumbling windows, or sliding ones with ``slide``: window_start, window_end, keys and aggregates."""
    rows = events.withWatermark(time, late) if late else events
    found = rows.groupBy(F.window(time, width, slide) if slide else F.window(time, width), *by).agg(*aggregates)
    return found.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *[c for c in found.columns if c != "window"])


def sessions(events: DataFrame, time: str, gap: str, aggregates: list[Column], by: list[Column | str], late: str | None = None) -> DataFrame:
    """Sessions that end after ``gap`` without an event; exactly ``gap`` apart is the same session."""
    rows = events.withWatermark(time, late) if late else events
    found = rows.groupBy(F.session_window(time, gap), *by).agg(*aggregates)
    return found.select(F.col("session_window.start").alias("session_start"), F.col("session_window.end").alias("session_end"), *[c for c in found.columns if c != "session_window"])


def previous_issue(issues: DataFrame, key: str, at: str, value: str) -> DataFrame:
    """A stream's issues with the value of the issue before, kept as state by key: key, at (microseconds), value, previous.

    Within a batch issues are taken by time; an issue older than the newest
    seen is late and gives no row. A batch's rows of one key are held at once
    (``in_time_order`` bounds them). Streaming frames only.
    """

    def follow(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        newest, last = state.get if state.exists else (-1, None)
        # Plain arrays: most keys have few rows a batch, and a data frame's own steps cost more than those.
        parts = [(f["at"].to_numpy(), f["value"].to_numpy(float)) for f in frames]
        at, values = (parts[0] if len(parts) == 1 else map(np.concatenate, zip(*parts, strict=True)))
        order = np.argsort(at, kind="stable")
        order = order[at[order] >= newest]
        if len(order):
            at, values = at[order], values[order]
            previous = np.concatenate([[np.nan if last is None else last], values[:-1]])
            state.update((int(at[-1]), float(values[-1])))
            yield pd.DataFrame({"key": keys[0], "at": at, "value": values, "previous": previous})

    rows = issues.select(F.col(key).alias("key"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(value).cast("double").alias("value"))
    return rows.groupBy("key").applyInPandasWithState(follow, "key long, at long, value double, previous double", "newest long, last double", "append", GroupStateTimeout.NoTimeout)


def running_max(events: DataFrame, key: list[Column | str], value: str) -> DataFrame:
    """The maximum so far by key; a stream appends it when the watermark has passed a window in the key, or updates it before."""
    return events.groupBy(*key).agg(F.max(value).alias("max_so_far"), F.count(value).alias("n"))


def drain(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", each: Callable[[DataFrame, int], None] | None = None) -> None:
    """Runs a stream over what is there now and stops. Results go to Parquet below ``path``, or to ``each`` batch's function."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").option("path", path).start()
    query.awaitTermination()


def in_time_order(rows: DataFrame, time: str, path: str, batch_rows: int, closing: str | None = None, key: str | None = None) -> tuple[str, int]:
    """Writes ``rows`` as files by time, whose file times are in that order, too: the folder, and the files that hold about ``batch_rows``.

    With ``key`` it is a key's rows in a batch that ``batch_rows`` bounds: if no
    key has more of them in all, one batch takes every file, and each key is
    called once, not once a batch.

    A file stream takes the oldest files first, so one run with that many files
    a trigger finds no row older than one of a batch before; nothing is sorted
    again and no stream is started twice. With ``closing`` the last file has one
    row, null but for that time, which is ten years behind all others: a
    watermark follows it and closes what is open. The file system must let file
    times be set (HDFS, local folders); one that does not is refused.
    """
    spark, folder = rows.sparkSession, f"{path}/in"
    n = rows.count()
    rows.repartitionByRange(max(1, -(-n // batch_rows)), time).write.parquet(folder)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = hadoop(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def parts() -> list[str]:
        return sorted(name for f in files.listStatus(hadoop(folder)) if (name := f.getPath().getName()).startswith("part-"))

    names = parts()
    if closing and n:
        last = rows.agg(F.max(closing).alias("t"))
        end = last.select(*[(F.col("t") + F.expr("INTERVAL 10 YEARS") if c == closing else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in rows.columns])
        end.coalesce(1).write.mode("append").parquet(folder)
        names += sorted(set(parts()) - set(names))
    began = files.getFileStatus(hadoop(f"{folder}/{names[0]}")).getModificationTime() if names else 0
    for k, name in enumerate(names):
        at, when = hadoop(f"{folder}/{name}"), began + 1000 * k
        files.setTimes(at, when, -1)
        if files.getFileStatus(at).getModificationTime() != when:
            raise OSError(f"the times of files cannot be set below {folder}")
    if key and (rows.groupBy(key).count().agg(F.max("count")).first()[0] or 0) <= batch_rows:
        return folder, max(1, len(names))
    return folder, max(1, len(names) * batch_rows // max(n, 1))


def stream_table(spark: SparkSession, path: str, schema, files_per_batch: int = 1, glob: str | None = None) -> DataFrame:
    """A folder of Parquet files as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
