"""A feed that is asked at fixed times, as a streaming source with offsets.

A poll sees what has become available since the poll before. Offsets are the
times of polls, kept in the stream's checkpoint: a batch that failed asks for
the same polls again and gets the same rows, and a restarted stream goes on
behind the last that was committed. Each row carries the poll that received it,
so latency is the feed's and not the engine's.

The feed is a folder with one subfolder a poll (``land`` makes one from a
table). Polls are read by tasks, a file a partition.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema

NAME = "isobar_polls"
SLOT = "poll_us"


def _folder(path: str) -> tuple[pafs.FileSystem, str]:
    """A path's file system and its place there."""
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


def land(rows: DataFrame, time: str, minutes: int, path: str) -> None:
    """Writes ``rows`` below ``path``, in a folder for the first poll after each row's time. Null times are never available."""
    width = minutes * 60_000_000
    slot = (F.floor(F.unix_micros(F.col(time).cast("timestamp")) / width) + 1) * width
    dealt = rows.where(F.col(time).isNotNull()).withColumn(SLOT, slot)
    # A poll with very many rows is split between tasks.
    dealt.hint("rebalance", SLOT).write.partitionBy(SLOT).parquet(path)


class Poll(InputPartition):
    """One file of one poll."""

    def __init__(self, at: int, file: str):
        super().__init__(at)
        self.at, self.file = at, file


class Reader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.path, self.schema = options["path"], schema
        self.width = int(options["minutes"]) * 60_000_000

    def _slots(self) -> list[int]:
        system, at = _folder(self.path)
        names = (os.path.basename(f.path) for f in system.get_file_info(pafs.FileSelector(at)) if f.type == pafs.FileType.Directory)
        return sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{SLOT}="))

    def initialOffset(self) -> dict:
        slots = self._slots()
        return {"poll": slots[0] - self.width if slots else 0}

    def latestOffset(self) -> dict:
        """The last poll that there is."""
        slots = self._slots()
        return {"poll": slots[-1] if slots else 0}

    def partitions(self, start: dict, end: dict) -> list[Poll]:
        system, at = _folder(self.path)
        out = []
        for slot in self._slots():
            if start["poll"] < slot <= end["poll"]:
                files = system.get_file_info(pafs.FileSelector(f"{at}/{SLOT}={slot}"))
                out += [Poll(slot, f.path) for f in sorted(files, key=lambda f: f.path) if f.base_name.startswith("part-")]
        return out

    def read(self, partition: Poll) -> Iterator[pa.RecordBatch]:
        system, _ = _folder(self.path)
        schema = to_arrow_schema(self.schema)
        for batch in ds.dataset(partition.file, filesystem=system, format="parquet").to_batches(columns=[n for n in schema.names if n != SLOT]):
            columns = [pa.array([partition.at] * batch.num_rows, pa.int64()) if f.name == SLOT else batch.column(f.name).cast(f.type) for f in schema]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    def commit(self, end: dict) -> None:
        """Nothing is held for polls that are done."""


class Polls(DataSource):
    """``path``: the feed; ``minutes``: between polls; ``columns``: the schema of its rows, as DDL."""

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return f"{self.options['columns']}, {SLOT} long"

    def streamReader(self, schema: T.StructType) -> Reader:
        return Reader(schema, dict(self.options))


def poll(spark: SparkSession, path: str, columns: str, minutes: int) -> DataFrame:
    """The feed below ``path`` as a stream: its columns, and ``poll_us``, the poll that received the row."""
    spark.dataSource.register(Polls)
    return spark.readStream.format(NAME).options(path=path, minutes=str(minutes), columns=columns).load()


def received(rows: DataFrame, time: str) -> DataFrame:
    """The rows with at and received_at (microseconds) and latency, what lies between."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    return rows.select("*", at.alias("at"), F.col(SLOT).alias("received_at"), (F.col(SLOT) - at).alias("latency"))
