"""Both searches against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from compare import database

from isobar.llm import ann, exact_topk, queries


@pytest.fixture(scope="module")
def table(spark):
    """Vectors with copies, clusters, and rows that take no part."""
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 16))
    x[200:300] = x[0]
    x[300:500] += 4 * x[1]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [None] + [1.0] * 15), (2003, [float("nan")] * 16), (2004, [float("inf")] * 16), (2005, []), (None, [1.0] * 16), (2050, [1.0, 2.0]), (2051, [2.0, 1.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def brute(rows, score, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows])
    out = {}
    for q in np.flatnonzero(ids % 50 == 0):
        s = score(x, x[q])
        mask = ids != ids[q]
        order = np.lexsort((ids[mask], -s[mask]))[:k]
        out[int(ids[q])] = [(int(ids[mask][j]), s[mask][j]) for j in order]
    return out


def used(table, zero):
    rows = [(r.vec_id, r.embedding) for r in table.collect() if r.vec_id is not None and r.embedding and None not in r.embedding and np.isfinite(r.embedding).all()]
    return [r for r in rows if len(r[1]) == 16 and (zero or any(r[1]))]


def gathered(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_exact_products(spark, table, monkeypatch):
    monkeypatch.setattr(exact_topk, "ANNULUS_ROWS", 100)
    monkeypatch.setattr(exact_topk, "GROUP_ROWS", 60)
    monkeypatch.setattr(exact_topk, "GROUP_QUERIES", 7)
    found = gathered(exact_topk.top_products(table, "id % 50 = 0"))
    want = brute(used(table, True), lambda x, q: np.floor(256 * x) @ np.floor(256 * q), 5)
    assert {k: v for k, v in found.items() if k != 2050} == want and found[2050] == [(2051, 512 * 256 + 256 * 512)]
    assert exact_topk.top_products(table.limit(0), "id % 50 = 0").count() == 0


def test_exact_products_equal_their_sql(spark, sf):
    from compare import differences

    assert differences(queries.op3_pivot_distance(spark, sf), database(sf), queries.ORACLES["op3_pivot_distance"]) == []


def test_large_integers_stay_exact():
    rows, query = np.array([[2.0**40, 1.0], [2.0**40, 0.0]]), np.array([2.0**20, 1.0])
    assert exact_topk.products(rows, query).tolist() == [2**60 + 1, 2**60]


def test_neighbours(spark, table, monkeypatch):
    monkeypatch.setattr(ann, "BUCKET_ROWS", 200)
    monkeypatch.setattr(ann, "GROUP_ROWS", 50)
    monkeypatch.setattr(ann, "GROUP_QUERIES", 7)
    monkeypatch.setattr(ann, "BROADCAST_COMPONENTS", 0)
    found = gathered(ann.nearest_by_cosine(table, "id % 50 = 0"))
    want = brute(used(table, False), lambda x, q: (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum()), 5)
    assert set(found) == {*want, 2050}
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    for q, rows in want.items():
        exact = dict(brute(used(table, False), lambda x, q: (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum()), 10**6)[q]) if q == 0 else None
        assert len(found[q]) == len(rows)
        if exact:
            assert all(abs(s - exact[i]) < 1e-12 for i, s in found[q])
    assert [i for i, _ in found[0]] == [200, 201, 202, 203, 204]  # copies, in the order of their ids
    assert ann.nearest_by_cosine(table.limit(0), "id % 50 = 0").count() == 0


def test_recall_on_the_embeddings(spark, sf):
    found = gathered(queries.op1_multi_index_hashing(spark, sf))
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    want = brute(rows, lambda x, q: (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum()), 5)
    assert sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_probing_finds_the_whole_ball():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 16, (500, 4), dtype=np.uint16)
    codes[100:200] = codes[0] ^ (rng.random((100, 4)) < 0.5) * (1 << rng.integers(0, 16, (100, 4))).astype(np.uint16)
    queries = codes[:3]
    bits = [ann.apart(codes, q) for q in queries]
    for reach in ((0, 0, 0), (2, 2, 2), (0, 2, 5), (16, 5, 0)):
        found = {}
        for table in range(4):
            order = np.argsort(codes[:, table], kind="stable")
            q, r, d = ann.probe(codes[order], queries, table, np.array(reach))
            for pair, n in zip(zip(q.tolist(), order[r].tolist(), strict=True), d.tolist(), strict=True):
                assert pair not in found  # a pair comes from one table only
                found[pair] = n
        assert found == {(k, j): b[j].sum() for k, b in enumerate(bits) for j in np.flatnonzero(b.min(axis=1) <= reach[k]).tolist()}
        ball = {(k, j) for k, b in enumerate(bits) for j in np.flatnonzero(b.sum(axis=1) < 4 * (reach[k] + 1)).tolist()}
        assert ball <= set(found)


def test_radius_of_each_query():
    rng = np.random.default_rng(2)
    asked, bits = rng.integers(0, 6, 300), rng.integers(0, 60, 300)
    asked = np.append(asked, [7, 7, 9])
    bits = np.append(bits, [300, 5, 11])
    keep = ann.within_radius(asked, bits, 4, 3)
    for q in np.unique(asked):
        own = bits[asked == q]
        limit = np.sort(own)[3] + 3 if len(own) >= 4 else 384
        assert (keep[asked == q] == (own <= limit)).all()
    assert ann.within_radius(np.empty(0, np.int64), np.empty(0, np.int64), 4, 3).tolist() == []


@pytest.mark.parametrize("level", [0.5, 0.9, 0.99, 1.0])
def test_sure_distances_hold(level):
    """Bits drawn at the distance named are found as often as promised; the ball of the pigeonhole principle always is."""
    rng = np.random.default_rng(3)
    for tables in (16, 24):
        sure = ann.sure_distances(tables, level)
        assert (np.diff(sure) >= 0).all() and sure[16] == 384
        assert (sure >= np.minimum(384, tables * (np.arange(17) + 1) - 1)).all()
        for reach in (0, 2, 4):
            flips = rng.random((3000, 384)).argsort(axis=1).argsort(axis=1) < sure[reach]
            least = flips.reshape(3000, 24, 16).sum(axis=2)[:, :tables].min(axis=1)
            assert (least <= reach).mean() >= level - 0.03


def test_queries_near_and_far_get_their_own_reach(spark):
    """A dense half and a sparse half: the sparse one is probed again, wider, and both are found."""
    rng = np.random.default_rng(9)
    centres = rng.normal(size=(20, 24))
    x = np.vstack([centres[rng.integers(0, 20, 1500)] + 0.05 * rng.normal(size=(1500, 24)), rng.normal(size=(1500, 24))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    found = gathered(ann.nearest_by_cosine(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "id % 50 = 0"))
    want = brute(rows, lambda x, q: (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum()), 5)
    for half in (range(1500), range(1500, 3000)):
        asked = [q for q in want if q in half]
        assert sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in asked) >= 0.9 * 5 * len(asked)


def clustered(spark, n=4000, centres=60, dim=32):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(centres, dim))[rng.integers(0, centres, n)] + 0.15 * rng.normal(size=(n, dim))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>")


def test_both_indexes_look_at_few_rows_of_clusters(spark, monkeypatch):
    rows, table = clustered(spark)
    plans: list = []
    found = gathered(ann.nearest_by_cosine(table, "id % 50 = 0", report=plans))
    want = brute(rows, lambda x, q: (x * q).sum(axis=1) / np.sqrt((x * x).sum(axis=1)) / np.sqrt((q * q).sum()), 5)
    assert sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want) >= 0.9 * sum(map(len, want.values()))
    assert len(plans) == 1 and plans[0].share < 0.2
    monkeypatch.setattr(exact_topk, "ANNULUS_ROWS", 128)
    looked: list = []
    found = gathered(exact_topk.top_products(table, "id % 50 = 0", report=looked))
    assert found == brute(rows, lambda x, q: np.floor(256 * x) @ np.floor(256 * q), 5)
    seen, pairs = looked[0]
    assert seen < 0.5 * pairs


def test_a_query_with_few_candidates_probes_wider(spark):
    """Points along one line and one far from all of them still get k rows."""
    rows = [(i, [1.0, i / 1000, 0.0, 0.0]) for i in range(300)] + [(5000, [-1.0, 0.2, 3.0, -2.0])]
    found = gathered(ann.nearest_by_cosine(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "id % 50 = 0"))
    assert len(found) == 7 and all(len(r) == 5 for r in found.values())


def test_repeated_rows_shared_ids_and_clashing_columns(spark):
    """Rows repeated in full count once, an id with several vectors takes part with each and is never its own neighbour, other columns do not matter."""
    rng = np.random.default_rng(12)
    x = np.round(rng.normal(size=(70, 6)), 3)
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(i, v.tolist()) for i, v in enumerate(x[:9])] * 3 + [(50, x[3].tolist()), (50, (-x[4]).tolist()), (7, (2 * x[8]).tolist()), (None, x[0].tolist())]
    clashing = ("id", "vector", "vkey", "qkey", "dim", "ids", "asked", "unit", "code", "score", "rank", "query_id", "n", "q", "key", "place", "rows", "label", "a.b")
    schema = "vec_id long, embedding array<double>, " + ", ".join(f"`{c}` string" for c in clashing)
    table = spark.createDataFrame([(i, v, *[None] * len(clashing)) for i, v in rows], schema)
    distinct = sorted({(i, tuple(v)) for i, v in rows if i is not None})

    def best(score):
        out = {}
        for q in {i for i, _ in distinct if i % 50 == 0}:
            pairs = [(-score(np.array(v), np.array(w)), i) for j, w in distinct if j == q for i, v in distinct if i != q]
            out[q] = [(i, -s) for s, i in sorted(pairs)[:5]]
        return out

    want = best(lambda v, w: int(np.floor(256 * v) @ np.floor(256 * w)))
    assert gathered(exact_topk.top_products(table, "id % 50 = 0")) == want
    found = gathered(ann.nearest_by_cosine(table, "id % 50 = 0"))
    want = best(lambda v, w: float(v @ w / np.sqrt(v @ v) / np.sqrt(w @ w)))
    assert set(found) == set(want) and all(len(r) == 5 for r in found.values())
    hits = sum(len({i for i, _ in found[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.8 * sum(map(len, want.values()))
    assert all(i != q for q, own in found.items() for i, _ in own)
