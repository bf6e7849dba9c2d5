"""Packed grids, tiles, stencils and snapshots by hand."""

from __future__ import annotations

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import tiles
from isobar.sources import packed, snapshots


def message(values, reference, binary, decimal, bits) -> bytes:
    """A message by plain bit work; None has no bit."""
    there = [v for v in values if v is not None]
    sign = lambda x: abs(x) | (0x8000 if x < 0 else 0)
    head = struct.pack(">IfHHBB", len(values), reference, sign(binary), sign(decimal), bits, int(None in values))
    pack = lambda text: bytes(int(text[k : k + 8].ljust(8, "0"), 2) for k in range(0, len(text), 8))
    bitmap = pack("".join("0" if v is None else "1" for v in values)) if None in values else b""
    return head + bitmap + pack("".join(format(v, f"0{bits}b") for v in there) if bits else "")


def test_messages_are_unpacked(spark):
    rng = random.Random(5)
    cases = []
    for bits in (0, 1, 3, 8, 11, 17, 24, 32):
        for missing in (0.0, 0.4):
            values = [None if rng.random() < missing else rng.randrange(1 << bits) for _ in range(37)]
            cases.append((values, rng.choice([0.0, -273.25, 1.5e-3, 3.0e20]), rng.choice([-3, 0, 2]), rng.choice([-1, 0, 2]), bits))
    cases += [([], 1.0, 0, 0, 8), ([None] * 9, 1.0, 0, 0, 8)]
    df = spark.createDataFrame([(k, message(*case)) for k, case in enumerate(cases)] + [(99, None), (100, b"short")], "k int, m binary")
    found = {r.k: r.p for r in df.select("k", packed.unpacked(F.col("m")).alias("p")).collect()}
    assert found[99] is None and found[100] is None
    for k, (values, reference, binary, decimal, bits) in enumerate(cases):
        single = struct.unpack(">f", struct.pack(">f", reference))[0]
        want = [(i, (single + v * 2.0**binary) / 10.0**decimal) for i, v in enumerate(values) if v is not None]
        assert [p.place for p in found[k]] == [i for i, _ in want], k
        assert all(math.isclose(p.value, w, rel_tol=1e-12) for p, (_, w) in zip(found[k], want, strict=True)), k


def test_what_is_packed_comes_back(spark):
    rng = random.Random(6)
    grids = [[rng.choice([None, float("nan"), rng.uniform(-40, 60)]) if rng.random() < 0.3 else rng.uniform(-40, 60) for _ in range(n)] for n in (0, 1, 7, 64, 100)] + [[5.0] * 10, [0.0] * 3, [None] * 4, None]
    df = spark.createDataFrame(list(enumerate(grids)), "k int, g array<double>")
    rows = df.select("k", packed.packed(F.col("g"), 2).alias("m")).withColumn("p", packed.unpacked(F.col("m"))).collect()
    for r in rows:
        want = None if grids[r.k] is None else [(i, math.floor(v * 100 + 0.5) / 100) for i, v in enumerate(grids[r.k]) if v is not None and v == v]
        assert (r.p if r.p is None else [(p.place, pytest.approx(p.value)) for p in r.p]) == want


def _cells(rng, rows, cols, share=0.8):
    return [(r, c, rng.choice([None, float("nan")]) if rng.random() < 0.05 else rng.gauss(1e6, 3)) for r in range(rows) for c in range(cols) if rng.random() < share]


def test_stencil_over_tiles_equals_a_plain_one(spark):
    rng = random.Random(2)
    cells = _cells(rng, 23, 17) + [(3, 3, 1e6), (3, 3, 2e6)]
    df = spark.createDataFrame([("a", *c) for c in cells], "g string, row int, col int, value double")
    best: dict = {}
    for r, c, v in cells:
        if v is not None and v == v:
            best[r, c] = max(best.get((r, c), -1e300), v)
    found = tiles.stencil(df, ["g"], 2, size=5).collect()
    assert {(r.row, r.col) for r in found} == set(best) and len(found) == len(best)
    for r in found:
        near = np.array([v for (y, x), v in best.items() if abs(y - r.row) <= 2 and abs(x - r.col) <= 2])
        assert (r.n, r.min, r.max) == (len(near), pytest.approx(near.min(), abs=1e-6), pytest.approx(near.max(), abs=1e-6))
        assert r["mean"] == pytest.approx(near.mean(), rel=1e-12) and r.std == pytest.approx(near.std(), rel=1e-6, abs=1e-6)
    assert tiles.stencil(df.limit(0), ["g"], 2).count() == 0


def test_windows_read_only_their_chunks(spark, tmp_path):
    rng = random.Random(3)
    cells = _cells(rng, 90, 70)
    df = spark.createDataFrame(cells, "row long, col long, value double")
    path = f"{tmp_path}/tiles"
    tiles.write_tiles(df, path, size=4, chunk=4)
    windows = [(k, rng.randrange(-3, 30), rng.randrange(5, 33), rng.randrange(0, 30), rng.randrange(2, 34)) for k in range(12)] + [(99, 5, 4, 0, 9)]
    asked = spark.createDataFrame(windows, "place int, row0 long, row1 long, col0 long, col1 long")
    # A file of a chunk that no window touches cannot be read at all.
    chunks = sorted(p.name for p in (tmp_path / "tiles").iterdir() if p.name.startswith("chunk="))
    far = [c for c in chunks if int(c.split("=")[1]) in {spark.range(1).select(tiles.morton(F.lit(r), F.lit(c))).first()[0] for r in (4, 5) for c in (3, 4)}]
    assert far
    for name in far:
        for file in (tmp_path / "tiles" / name).iterdir():
            file.write_bytes(b"not a table")
    found = tiles.in_windows(spark, path, df.schema, asked, size=4, chunk=4)
    got = sorted((r.place, r.row, r.col, r.value) for r in found.collect())
    want = sorted((k, r, c, v) for k, r0, r1, c0, c1 in windows for r, c, v in cells if v is not None and v == v and r0 <= r <= r1 and c0 <= c <= c1)
    assert got == want
    assert tiles.in_windows(spark, path, df.schema, asked.limit(0), size=4, chunk=4).count() == 0


def test_morton_codes(spark):
    for row, col in ((0, 0), (1, 0), (0, 1), (5, 3), (2**31 - 1, 2**31 - 1)):
        want = sum((row >> k & 1) << (2 * k + 1) | (col >> k & 1) << (2 * k) for k in range(31))
        assert spark.range(1).select(tiles.morton(F.lit(row), F.lit(col)).alias("m")).first().m == want


def test_snapshots(spark, tmp_path):
    path = f"{tmp_path}/table"
    assert snapshots.versions(spark, path) == []
    with pytest.raises(ValueError):
        snapshots.read(spark, path)
    one, two = spark.range(5).withColumn("v", F.lit("a")), spark.range(3).withColumn("v", F.lit("b"))
    assert snapshots.commit(one, path) == 1

    def fails(_):
        raise RuntimeError("while it writes")

    broken = two.select("id", F.udf(fails, "string")("v").alias("v"))
    with pytest.raises(Exception):
        snapshots.commit(broken, path, based_on=1)
    assert snapshots.read(spark, path).count() == 5 and snapshots.versions(spark, path) == [1]
    assert snapshots.commit(two, path, based_on=1) == 2
    with pytest.raises(snapshots.LostRace):
        snapshots.commit(one, path, based_on=1)
    with pytest.raises(snapshots.LostRace):
        snapshots.create_json(spark, f"{path}/versions/000000000002.json", {})
    assert sorted(map(tuple, snapshots.read(spark, path).collect())) == [(0, "b"), (1, "b"), (2, "b")]
    assert snapshots.read(spark, path, 1).count() == 5
    # A manifest that is being created just now.
    (tmp_path / "table" / "versions" / "000000000003.json").write_text('{"version": 3, "fol')
    assert snapshots.read(spark, path).count() == 3
    assert len(snapshots.unnamed_folders(spark, path)) >= 1
