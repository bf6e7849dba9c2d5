"""Whitening and fill-in-middle against plain versions of their rules."""

from __future__ import annotations

import hashlib
import math
import random
import re
from fractions import Fraction

import compare
import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import fill_in_middle as fim
from isobar.llm import queries, whitening


def plain_whitening(vectors: dict, k: int):
    xs = {i: [math.floor(64 * float(c)) + 1_000_000 for c in v] for i, v in vectors.items()}
    n, dim = len(xs), len(next(iter(xs.values())))
    sums = [sum(x[d] for x in xs.values()) for d in range(dim)]
    centred = np.array([[float(Fraction(n * x[d] - sums[d], n)) for d in range(dim)] for x in xs.values()])
    cov = np.array([[float(sum(Fraction(n * x[a] - sums[a]) * (n * x[b] - sums[b]) for x in xs.values()) / n**3) for b in range(dim)] for a in range(dim)])
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1], v[:, ::-1]
    deviation = {i: sum((n * x[d] - sums[d]) ** 2 for d in range(dim)) for i, x in xs.items()}
    return deviation, centred, e, v, cov


def test_whitening_equals_a_plain_one(spark):
    rng = np.random.default_rng(3)
    mixed = rng.normal(size=(40, 6)) @ rng.normal(size=(6, 6)) * [1, 1, 10, 0.2, 3, 1] + [0, 5, -3, 100, 0, 0]
    vectors = dict(enumerate(mixed.tolist()))
    df = spark.createDataFrame(list(vectors.items()), "vec_id long, embedding array<double>").repartition(3)
    rows = whitening.whitened(df, components=4).collect()
    deviation, centred, e, v, cov = plain_whitening(vectors, 4)
    assert len(rows) == 160 and {r.n for r in rows} == {40}
    got = np.zeros((40, 4))
    for r in rows:
        assert r.deviation == deviation[r.vec_id]
        assert r.explained == pytest.approx(e[r.component - 1] / np.trace(cov), rel=1e-9)
        got[r.vec_id, r.component - 1] = r.whitened
    want = centred @ v[:, :4] / np.sqrt(e[:4])
    signs = np.sign((got * want).sum(axis=0))
    assert np.abs(got - want * signs).max() < 1e-8
    error = np.abs(got.T @ got / 40 - np.eye(4)).max()
    assert rows[0].identity_error == pytest.approx(error, abs=1e-9) and error < 1e-9


def test_whitening_is_exact_beyond_longs_and_near_constant(spark):
    big = [[1e9 * k, 1.0, 0.5 if k == 3 else 0.25] for k in range(7)]
    df = spark.createDataFrame(list(enumerate(big)), "vec_id long, embedding array<double>")
    rows = whitening.whitened(df, components=3).collect()
    deviation, _, e, _, cov = plain_whitening(dict(enumerate(big)), 3)
    assert {r.vec_id: r.deviation for r in rows} == {i: d if d < 1 << 63 else None for i, d in deviation.items()}
    assert all(r.whitened is None for r in rows if r.component == 3), "a dimension without variance"
    assert all(r.explained == pytest.approx(e[0] / np.trace(cov)) for r in rows if r.component == 1)


def test_whitening_of_odd_rows(spark):
    odd = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [4.0, 4.0]), (8, [2.0, 2.0, 2.0]), (9, [1e300, 1.0]), (1, [0.0, 9.0])]
    df = spark.createDataFrame([(i, v, 1, 2.0, "w") for i, v in odd], "vec_id long, embedding array<double>, component int, x double, w string")
    rows = whitening.whitened(df).collect()
    two = [r for r in rows if r.n == 5]
    assert sorted((r.vec_id or -1, r.component) for r in two) == sorted([(1, 1), (1, 2)] * 3 + [(-1, 1), (-1, 2), (7, 1), (7, 2)])
    assert max(r.identity_error for r in two) < 1e-9
    alone = [r for r in rows if r.n == 1]
    assert [(r.vec_id, r.component, r.deviation, r.whitened, r.explained, r.identity_error) for r in sorted(alone, key=lambda r: r.component)] == [(8, c, 0, None, None, None) for c in (1, 2, 3)]
    assert whitening.whitened(df.limit(0)).count() == 0
    copies = spark.createDataFrame([(k, [1.0, 2.0]) for k in range(9)], "vec_id long, embedding array<float>")
    assert {(r.deviation, r.whitened) for r in whitening.whitened(copies).collect()} == {(0, None)}


def test_pairs_in_several_aggregations(spark, monkeypatch):
    monkeypatch.setattr(whitening, "PAIRS", 4)
    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(k, rng.normal(size=5).tolist()) for k in range(30)], "vec_id long, embedding array<double>")
    assert max(r.identity_error for r in whitening.whitened(df, components=5).collect()) < 1e-9


def plain_middle(id_: str, text: str, percent: int = 100):
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n, h = len(units), hashlib.sha256(f"7:{id_}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= percent:
        return n, "plain", None, None, text
    if h4 % 100 < 50:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("percent", [100, 60])
def test_fill_in_middle_equals_a_plain_one(spark, odd, percent):
    rng = random.Random(2)
    texts = ["".join(rng.choice(["\n", "a", "é", "日", "\r", "\x0b", " ", "<", "P>", "<S", " "]) for _ in range(rng.randrange(60))) for _ in range(200)]
    texts += ["\n" * 3000, "x" * 2000, ("line é\n" * 5000) + "end", "<P>", "a<S>b\nc", "\n", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rules = fim.Rules(percent=percent)
    for source in (df, odd):
        found = fim.fill_in_middle(source, rules, keep=("doc_id", "text"))
        rows = found.withColumn("back", fim.restored(F.col("output"), F.col("form"), rules)).collect()
        assert len(rows) == source.count()
        for r in rows:
            text = r.text or ""
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_middle("" if r.doc_id is None else str(r.doc_id), text, percent)
            assert r.back == text
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_rank_and_select():
    rng = np.random.default_rng(1)
    for size in (0, 1, 511, 512, 513, 4_000):
        for share in (0.0, 0.01, 0.5, 1.0):
            bits = rng.random(size) < share
            vector, places = fim.BitVector(bits), np.flatnonzero(bits)
            assert vector.ones == len(places)
            assert [vector.select(k + 1) for k in range(len(places))] == places.tolist()
            assert [vector.rank(k) for k in range(size + 1)] == [int(bits[:k].sum()) for k in range(size + 1)]


def test_sentinels_that_cannot_be_told_apart_are_refused():
    for marks in (("<P>", "<P>", "<M>"), ("", "<S>", "<M>"), ("ab", "bc", "x"), ("aa", "b", "c"), ("abc", "b", "x")):
        with pytest.raises(ValueError):
            fim.Rules(prefix=marks[0], suffix=marks[1], middle=marks[2])


def test_the_query_equals_its_sql(spark, sf):
    assert compare.differences(queries.op13_fill_in_middle(spark, sf), compare.database(sf), queries.ORACLES["op13_fill_in_middle"]) == []


def test_the_whitening_query_has_small_error(spark, sf):
    rows = queries.op12_whitening(spark, sf).select("component", "identity_error", "n").distinct().collect()
    assert sorted(r.component for r in rows) == list(range(1, 33)) and max(r.identity_error for r in rows) < 1e-4
