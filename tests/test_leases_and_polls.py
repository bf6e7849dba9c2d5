"""Leases by hand, and a polled feed whose stream fails and starts again."""

from __future__ import annotations

import datetime as dt

import pytest

from isobar.streaming import leases, polling, streams

H = leases.HOUR


def ended(events, budget=3):
    machine = leases.Machine(7, 6 * H, budget)
    for at, kind in events:
        machine.take(at * H, kind)
    machine.pass_time(10**6 * H)
    return [(a // H, z // H, beats, attempt, status) for _, a, z, beats, attempt, status in machine.ended]


def test_leases_are_renewed_end_and_expire():
    assert ended([(0, "beat"), (5, "beat"), (10, "done")]) == [(0, 10, 3, 1, "done")]
    assert ended([(0, "beat"), (6, "beat")]) == [(0, 6, 1, 1, "expired"), (6, 12, 1, 2, "expired")], "a lease has expired at its very end"
    assert ended([(0, "failed"), (1, "beat"), (2, "failed"), (3, "done"), (4, "beat")]) == [(0, 0, 1, 1, "failed"), (1, 2, 2, 2, "failed"), (3, 3, 1, 3, "done"), (4, 10, 1, 1, "expired")]
    assert ended([(0, "failed"), (1, "failed"), (2, "failed"), (3, "done"), (9, "beat")]) == [(k, k, 1, k + 1, "failed") for k in range(3)], "refused beyond the budget"
    assert ended([(0, "beat"), (1, "done")], budget=1) == [(0, 1, 2, 1, "done")]
    assert ended([]) == []


def test_state_is_kept_between_batches():
    machine = leases.Machine(7, 6 * H, 3)
    machine.take(0, "beat")
    later = leases.Machine(7, 6 * H, 3, machine.state)
    later.take(2 * H, "done")
    assert later.ended == [(7, 0, 2 * H, 2, 1, "done")] and later.state == (-1, -1, 2, 0, False, 2 * H)


def test_a_failed_batch_is_polled_again_and_a_restart_goes_on(spark, tmp_path):
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(k, at + dt.timedelta(minutes=7 * k)) for k in range(60)] + [(99, None)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp")
    feed, state, out = f"{tmp_path}/feed", f"{tmp_path}/state", f"{tmp_path}/out"
    polling.land(events.where("event_id < 30 OR event_id = 99"), "ts", 30, feed)
    stream = polling.received(polling.poll(spark, feed, "event_id long, ts timestamp", 30), "ts")
    seen = []

    def fails(batch, n):
        seen.append(sorted(r.event_id for r in batch.collect()))
        raise RuntimeError("a failed batch")

    with pytest.raises(Exception):
        streams.drain(stream, out, state, each=fails)
    streams.drain(stream, out, state, each=lambda batch, n: batch.write.mode("append").parquet(out))
    assert seen == [list(range(30))]
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == seen[0], "the same polls again, once"
    # The poll that event 30 falls into is later than what is committed.
    late = events.where("event_id >= 30")
    polling.land(late, "ts", 30, f"{tmp_path}/more")
    import shutil

    for name in (p.name for p in (tmp_path / "more").iterdir() if p.name.startswith("poll_us=")):
        if not (tmp_path / "feed" / name).exists():
            shutil.move(tmp_path / "more" / name, tmp_path / "feed" / name)
    streams.drain(stream, out, state, each=lambda batch, n: batch.write.mode("append").parquet(out))
    found = spark.read.parquet(out).collect()
    assert len(found) == len({r.event_id for r in found}) > 50
    assert all(0 < r.latency <= 30 * 60_000_000 and r.received_at % (30 * 60_000_000) == 0 for r in found)
