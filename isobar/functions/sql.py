"""The library's functions by name, for SQL text.

Scalar functions are SQL expressions that the optimizer inlines, so they stay in
the JVM; ``bulletin_cells`` is a table function for a lateral join, in Arrow
batches.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: name, arguments, type and body. Conversions are fixed values.
SCALARS = (
    ("kelvin_to_f", "k DOUBLE", "DOUBLE", "(k - 273.15) * 9 / 5 + 32"),
    ("celsius_to_f", "c DOUBLE", "DOUBLE", "c * 9 / 5 + 32"),
    ("whole_f", "c DOUBLE", "INT", "CAST(floor(c * 9 / 5 + 32 + 0.5) AS INT)"),
    ("mps_to_mph", "v DOUBLE", "DOUBLE", "v * 2.2369362920544"),
    ("longitude_180", "lon DOUBLE", "DOUBLE", "CASE WHEN lon > 180 THEN lon - 360 ELSE lon END"),
    ("wind_speed", "u DOUBLE, v DOUBLE", "DOUBLE", "sqrt(u * u + v * v)"),
    ("local_day", "t TIMESTAMP_NTZ, zone STRING", "DATE", "CAST(convert_timezone('UTC', zone, t) AS DATE)"),
    ("pinball", "y DOUBLE, q DOUBLE, level DOUBLE", "DOUBLE", "greatest(level * (y - q), (level - 1) * (y - q))"),
)
BLOCK = re.compile(r"\s*([A-Z0-9]{4})\s+.*?(\d{1,2}/\d{1,2}/\d{4})\s+(\d{4})\s*UTC\s*")


@F.udtf(returnType="station string, label string, forecast_hour int, valid_utc timestamp_ntz, token string, value double", useArrow=True)
class BulletinCells:
    """A row for each cell of each station block of a bulletin's text that stands below an hour."""

    def eval(self, text: str) -> Iterator[tuple]:
        block: tuple[str, dt.datetime] | None = None
        hours: list[dt.datetime | None] = []
        waiting: list[tuple[str, list[str]]] = []

        def finished() -> Iterator[tuple]:
            for label, cells in waiting:
                for cell, valid in zip(cells, hours, strict=False):
                    if valid is not None:
                        token = cell.strip()
                        number = float(token) if re.fullmatch(r"-?\d+", token) and not re.fullmatch("9+", token) else None
                        yield block[0], label, int((valid - block[1].replace(minute=0)).total_seconds() // 3600), valid, token or None, number

        for line in re.split(r"\r?\n", text or ""):
            if head := BLOCK.fullmatch(line):
                yield from finished()
                block, hours, waiting = (head[1], dt.datetime.strptime(f"{head[2]} {head[3]}", "%m/%d/%Y %H%M")), [], []
            elif block and (label := line[:4].strip()):
                cells = [line[k : k + 3] for k in range(5, len(line), 3)]
                if label == "UTC":
                    at, day = block[1].replace(minute=0), 0
                    for cell in cells:
                        if not cell.strip().isdigit():
                            hours.append(None)
                            continue
                        hour = int(cell)
                        day += hour < (hours[-1] or at).hour if hours else hour < at.hour
                        hours.append(at.replace(hour=0) + dt.timedelta(days=day, hours=hour))
                else:
                    waiting.append((label, cells))
        yield from finished()


def register(spark: SparkSession) -> None:
    """Makes all functions known to ``spark.sql``, for this session."""
    for name, arguments, kind, body in SCALARS:
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({arguments}) RETURNS {kind} RETURN {body}")
    spark.udtf.register("bulletin_cells", BulletinCells)
