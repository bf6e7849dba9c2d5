"""Leases over a log of task events: taken, renewed, finished, given back, expired, and refused beyond a budget.

The log of a task is a keyed state machine with one event-time timer. An event
takes the task if nobody holds it and renews the lease if somebody does; a
``done`` or ``failed`` event ends it; a lease that is not renewed in time
expires, when the timer fires or when a later event shows it. After ``budget``
leases in a row without ``done`` the task is refused: its events have no effect
any more. State is six numbers a task and goes after ``keep_days`` without an
event.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

SCHEMA = "task long, leased_at long, ended_at long, beats long, attempt long, status string"
STATE = "leased_at long, expires_at long, beats long, attempt long, refused boolean, seen long"
HOUR, DAY = 3_600_000_000, 86_400_000_000


class Machine:
    """One task's state. ``leased_at`` is -1 while nobody holds the lease; times are microseconds."""

    def __init__(self, task: int, lease: int, budget: int, state: tuple | None = None):
        self.task, self.lease, self.budget = task, lease, budget
        self.leased_at, self.expires_at, self.beats, self.attempt, self.refused, self.seen = state or (-1, -1, 0, 0, False, -1)
        self.ended: list[tuple] = []

    @property
    def state(self) -> tuple:
        return self.leased_at, self.expires_at, self.beats, self.attempt, self.refused, self.seen

    def _end(self, at: int, status: str) -> None:
        self.ended.append((self.task, self.leased_at, at, self.beats, self.attempt, status))
        if status == "done":
            self.attempt = 0
        self.refused = status != "done" and self.attempt >= self.budget
        self.leased_at = self.expires_at = -1

    def pass_time(self, now: int) -> None:
        """Time has come to ``now``: a lease whose end that is has expired."""
        if self.leased_at >= 0 and self.expires_at <= now:
            self._end(self.expires_at, "expired")

    def take(self, at: int, kind: str) -> None:
        """An event at ``at``: done, failed, or any other that holds the lease."""
        self.pass_time(at)
        self.seen = max(self.seen, at)
        if self.refused:
            return
        if self.leased_at < 0:
            self.leased_at, self.beats, self.attempt = at, 0, self.attempt + 1
        self.beats, self.expires_at = self.beats + 1, at + self.lease
        if kind in ("done", "failed"):
            self._end(at, kind)


def states(log: DataFrame, task: str, at: str, order: str, kind: str, lease_hours: float, budget: int, late: str, keep_days: int = 30) -> DataFrame:
    """A row for each lease that has ended: task, leased_at, ended_at (microseconds), beats (its events), attempt (since the last done) and status (done, failed, expired).

    ``log`` is a stream; events are taken by ``at`` and ``order`` within a
    batch, those older than the watermark (``late`` behind the newest) are
    dropped. Null tasks or times have no lease. A batch's events of one task
    are held at once.
    """
    lease = int(lease_hours * HOUR)

    def follow(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        machine = Machine(int(keys[0]), lease, budget, state.get if state.exists else None)
        watermark = state.getCurrentWatermarkMs() * 1000
        if state.hasTimedOut:
            machine.pass_time(watermark)
        else:
            events = [e for f in frames for e in zip(f["at"].tolist(), f["order"].tolist(), f["kind"].tolist(), strict=True) if e[0] >= watermark]
            # a list, not a data frame: most tasks have few events a batch; those without a number are last
            missing = lambda n: n is None or n != n
            for moment, _, what in sorted(events, key=lambda e: (e[0], missing(e[1]), 0 if missing(e[1]) else e[1])):
                machine.take(moment, what)
            machine.pass_time(watermark)
        until = machine.expires_at if machine.leased_at >= 0 else machine.seen + keep_days * DAY
        if machine.leased_at < 0 and until <= watermark:
            state.remove()
        else:
            state.update(machine.state)
            # Timers are in milliseconds, rounded up, and must lie behind the watermark.
            state.setTimeoutTimestamp(max(-(-until // 1000), watermark // 1000 + 1))
        if machine.ended:
            yield pd.DataFrame(machine.ended, columns=["task", "leased_at", "ended_at", "beats", "attempt", "status"])

    rows = log.withWatermark(at, late).where(F.col(at).isNotNull())
    rows = rows.select(F.col(task).cast("long").alias("task"), F.unix_micros(F.col(at).cast("timestamp")).alias("at"), F.col(order).cast("long").alias("order"), F.col(kind).alias("kind"), F.col(at).alias("__watermark"))
    return rows.where("task is not null").groupBy("task").applyInPandasWithState(follow, SCHEMA, STATE, "append", GroupStateTimeout.EventTimeTimeout)
