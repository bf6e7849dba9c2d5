"""Fixed-width bulletins, inventories and archives of text."""

from __future__ import annotations

import io
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from isobar.functions.parse import bulletin_value, inventory_line

#: A station block begins with: station, product words, date and time of issue.
HEADER = r"^\s*([A-Z0-9]{4})\s+.*?(\d{1,2}/\d{1,2}/\d{4})\s+(\d{4})\s*UTC\s*$"
FIRST_CELL, CELL = 5, 3


def whole_texts(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row a file: source_path and text. gzip is read as it is."""
    reader = spark.read.option("wholetext", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.text(path).select(F.col("_metadata.file_path").alias("source_path"), F.col("value").alias("text"))


def bulletin_rows(texts: DataFrame, station: str | None = None) -> DataFrame:
    """A row for each cell of each station block: station, init_utc, label, cell (from 1), token and value.

    Lines are numbered in their file, and a header's block runs to the next
    header; a cell is three characters from the sixth on.
    """
    lines = texts.select("source_path", F.posexplode(F.split("text", r"\r?\n")).alias("line_no", "line"))
    def part(k: int) -> Column:
        return F.regexp_extract("line", HEADER, k)

    head = F.when(part(1) != "", F.struct(part(1).alias("station"), F.try_to_timestamp(F.concat_ws(" ", part(2), part(3)), F.lit("M/d/yyyy HHmm")).cast("timestamp_ntz").alias("init_utc")))
    order = Window.partitionBy("source_path").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    body = lines.withColumn("__head", head).withColumn("__block", F.last("__head", ignorenulls=True).over(order)).where("__head is null and __block is not null")
    label = F.trim(F.substring("line", 1, FIRST_CELL - 1))
    n = F.greatest(F.ceil((F.length("line") - FIRST_CELL) / CELL), F.lit(0)).cast("int")
    cells = F.transform(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")), lambda k: F.substring(F.col("line"), FIRST_CELL + 1 + (k - 1) * CELL, F.lit(CELL)))
    out = body.where(label != "").select("source_path", "__block.station", "__block.init_utc", label.alias("label"), F.posexplode(cells).alias("cell", "token")).withColumn("cell", F.col("cell") + 1)
    out = out.withColumn("value", bulletin_value(F.col("token"), F.col("label"))).withColumn("token", F.nullif(F.trim("token"), F.lit("")))
    return out if station is None else out.where(F.col("station") == station)


def bulletin_hours(rows: DataFrame, hour_label: str = "UTC") -> DataFrame:
    """The cells with their valid time: the hours of the block's hour row, rolled over midnight."""
    hours = rows.where(F.col("label") == hour_label).select("source_path", "station", "init_utc", "cell", F.col("value").alias("hour"))
    start = F.hour("init_utc")
    order = Window.partitionBy("source_path", "station", "init_utc").orderBy("cell")
    days = F.sum(F.when(F.col("hour") < F.coalesce(F.lag("hour").over(order), start), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    lead = (F.col("hour") + 24 * days - start).cast("int")
    timed = hours.withColumn("forecast_hour", lead).drop("hour")
    out = rows.where(F.col("label") != hour_label).join(timed, ["source_path", "station", "init_utc", "cell"])
    return out.withColumn("valid_utc", F.date_trunc("hour", F.col("init_utc").cast("timestamp")).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("forecast_hour")))


def inventory(lines: DataFrame, content_length: Column | None = None) -> DataFrame:
    """Typed inventory records (source_path, line): a record's length runs to the next offset, the last to the file's end."""
    typed = lines.select("source_path", inventory_line(F.col("line")).alias("r")).where("r is not null").select("source_path", "r.*")
    after = F.lead("offset").over(Window.partitionBy("source_path").orderBy("offset", "record"))
    end = after if content_length is None else F.coalesce(after, content_length)
    return typed.withColumn("length", end - F.col("offset"))


def chosen_members(members: DataFrame, first: str, last: str, cycles: list[int]) -> DataFrame:
    """Archive members whose name holds an issue (YYYYMMDD, then a separator or T, then HH) within the closed days and of one of the cycles: with issue_date and cycle."""
    found = r"(\d{4})(\d{2})(\d{2})[._T-]?(\d{2})"
    day = F.concat_ws("-", *[F.regexp_extract("member", found, k) for k in (1, 2, 3)])
    issued = members.withColumns({"issue_date": F.when(F.rlike("member", F.lit(found)), day).try_cast("date"), "cycle": F.regexp_extract("member", found, 4).try_cast("int")})
    return issued.where(F.col("issue_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & F.col("cycle").isin(cycles))


def archive_members(spark: SparkSession, path: str, glob: str) -> DataFrame:
    """source_path, member and text of the text files in tar archives, also gzipped; a broken archive gives no rows but its error."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                try:
                    # A stream: unpacked a member at a time.
                    with tarfile.open(fileobj=io.BytesIO(content), mode="r|*") as archive:
                        rows += [(name, m.name, archive.extractfile(m).read().decode("utf-8", "replace"), None) for m in archive if m.isfile()]
                except (OSError, EOFError, tarfile.TarError) as error:
                    rows.append((name, None, None, str(error)))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(4)], names=["source_path", "member", "text", "error"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path", "content")
    return files.mapInArrow(members, "source_path string, member string, text string, error string")
