"""Local time, cutoffs and calendar features. Instants are UTC timestamps without zone."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

ZONE = "America/New_York"
CUTOFF_MINUTES = 5


def local(ts: Column, zone: str = ZONE) -> Column:
    """Wall-clock time in ``zone`` of a UTC instant."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def utc(wall: Column, zone: str = ZONE) -> Column:
    """The UTC instant of a wall-clock time."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), wall.cast("timestamp_ntz"))


def local_date(ts: Column, zone: str = ZONE) -> Column:
    return local(ts, zone).cast("date")


def cutoff(day: Column, minutes: int = CUTOFF_MINUTES, zone: str = ZONE) -> Column:
    """The UTC instant ``minutes`` after local midnight of ``day``; hours are added to instants, so DST days are right."""
    return utc(day.cast("timestamp_ntz") + F.make_dt_interval(mins=F.lit(minutes)), zone)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch, whatever the session's zone."""
    return F.unix_micros(ts.cast("timestamp_ntz").cast("timestamp"))


def season(day: Column, first: int = 4, last: int = 10) -> Column:
    """warm from month ``first`` to ``last``, else cool; modules of the models differ in the months."""
    return F.when(F.month(day).between(first, last), "warm").otherwise("cool")


def day_angle(day: Column) -> tuple[Column, Column]:
    """Sine and cosine of the day of the year."""
    angle = F.dayofyear(day) * (2 * math.pi / 365.25)
    return F.sin(angle), F.cos(angle)
