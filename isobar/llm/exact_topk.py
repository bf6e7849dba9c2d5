"""Exact top-k search with a pivot-distance index.

Scores are integer inner products. A vector x is given the further component
sqrt(M - |x|^2), with M the largest squared length, and a query the component
0; the distance of the two is then a falling function of their product, and
the triangle inequality holds. Every vector is keyed by its nearest pivot and
its distance to it; the cluster is sorted by that key and cut into annuli of
bounded size, whose inner and outer distances are a small table.

A query's k-th best score in the bounded sample that gave the pivots bounds
how far a better vector can be. It is sent to those annuli only that the bound
reaches from its distance to their pivot. In an annulus it takes the rows in
reach, nearest first, and goes on with the bound of what it has found; it
stops where the triangle inequality rules out the rest. Every vector is sent
once. Bounds have room for rounding; products themselves are exact.

Vectors that are null or hold null or non-finite components take no part, nor
do rows with a null id; vectors of different lengths do not meet; a zero vector
takes part. Copies are one vector until the end (``vectors``); a row repeated
in full counts once; an id with several vectors takes part with each, and is
never its own neighbour. Ties go to the smaller id. Scores that do not fit a
long are an error. Fewer candidates than k give fewer rows, an empty table
gives none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import checkpointed
from isobar.llm.vectors import best_of_each, bounded_sample, distinct_vectors, in_groups, stacked, whole_vectors

SAMPLE = 4_096
PIVOTS = 64
#: Rows of an annulus, about, and most annuli; rows and queries that meet in one task.
ANNULUS_ROWS, ANNULI, GROUP_ROWS, GROUP_QUERIES = 4_096, 65_536, 16_384, 4_096
#: Rows that a query takes before it looks at its bound again.
STEP_ROWS = 512
EXACT = 2.0**53


def pick_pivots(sample: np.ndarray, pivots: int = PIVOTS, rounds: int = 8, seed: int = 5) -> np.ndarray:
    """Centres of the sample, by a few rounds of k-means."""
    if not len(sample):
        return np.zeros((1, sample.shape[1]))
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(pivots, len(sample)), replace=False)].copy()
    for _ in range(rounds):
        nearest = squared(sample, centres).argmin(axis=1)
        for j in range(len(centres)):
            if (nearest == j).any():
                centres[j] = sample[nearest == j].mean(axis=0)
    return centres


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to the few rows of b."""
    return np.maximum((a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None] - 2 * a @ b.T, 0)


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact integer inner products."""
    if (np.abs(rows) @ np.abs(query)).max(initial=0) < EXACT:
        return (rows @ query).astype(np.int64)
    return np.array([sum(int(a) * int(b) for a, b in zip(row, query, strict=True)) for row in rows.tolist()], dtype=np.int64)


def reach(floor: np.ndarray, length: np.ndarray, most: float) -> np.ndarray:
    """How far from a query of squared ``length`` a vector of score ``floor`` or more can be."""
    return np.sqrt(np.maximum(most + length - 2 * floor, 0) + 4e-6 * (most + length + 1))


def search_annulus(vkeys: np.ndarray, least: np.ndarray, vectors: np.ndarray, distance: np.ndarray, query: np.ndarray, floor: float, to_pivot: float, most: float, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """The best ``k`` scores, at least ``floor``, among rows in the order of their distance to the pivot: vkeys, scores, and how many rows were looked at.

    ``least`` decides ties.
    """
    length = float(query @ query)
    got, scores, ties, seen = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), 0
    low = high = int(np.searchsorted(distance, to_pivot))
    room = float(reach(np.float64(floor), np.float64(length), most))
    while True:
        # The next rows inwards and outwards that the bound still reaches.
        a, b = max(int(np.searchsorted(distance, to_pivot - room)), low - STEP_ROWS), min(int(np.searchsorted(distance, to_pivot + room, "right")), high + STEP_ROWS)
        rows = np.concatenate([np.arange(min(a, low), low), np.arange(high, max(b, high))])
        if not len(rows):
            return got, scores, seen
        low, high, seen = min(a, low), max(b, high), seen + len(rows)
        new = products(vectors[rows], query)
        keep = new >= floor
        if keep.any():
            got, scores, ties = np.concatenate([got, vkeys[rows][keep]]), np.concatenate([scores, new[keep]]), np.concatenate([ties, least[rows][keep]])
            if len(got) >= k:
                first = np.lexsort((ties, -scores))[:k]
                got, scores, ties = got[first], scores[first], ties[first]
                floor = max(floor, float(scores[-1]))
                room = float(reach(np.float64(floor), np.float64(length), most))


def top_products(df: DataFrame, is_query: str, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", report: list | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score (long): each query's k largest inner products of floor(scale * x) with all other rows.

    ``is_query`` is a condition on the column ``id``. ``report`` gets the
    number of pairs looked at and of all pairs of distinct vectors.
    """
    spark = df.sparkSession
    whole = whole_vectors(df, id_col, vector_col).withColumn("vector", F.transform("vector", lambda x: F.when(F.abs(x * scale) < EXACT / 2, F.floor(x * scale).cast("double")).otherwise(x * scale)))
    distinct, queries = distinct_vectors(whole, is_query, k)
    length = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    sizes = distinct.groupBy("dim").agg(F.count("*").alias("n"), F.max(length).alias("most"), F.count_if("asked").alias("q")).collect()
    models = {}
    for r in sizes:
        sample = bounded_sample(distinct.where(F.col("dim") == r.dim), r.n, SAMPLE).select("vector", F.size("ids").alias("ids")).toArrow()
        x = stacked(sample.column("vector"), r.dim)
        models[r.dim] = pick_pivots(_lifted(x, r.most)), r.most, x, sample.column("ids").to_numpy()
    sent = spark.sparkContext.broadcast(models)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows)
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                pivots, most, *_ = sent.value[dim]
                d = squared(_lifted(stacked(batch.column("vector").take(pa.array(rows)), dim), most), pivots)
                pivot[rows], distance[rows] = d.argmin(axis=1), np.sqrt(d.min(axis=1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot), pa.array(distance)], names=["vkey", "vector", "dim", "ids", "asked", "pivot", "distance"])

    total = sum(r.n for r in sizes)
    index = distinct.mapInArrow(keyed, "vkey long, vector array<double>, dim int, ids array<long>, asked boolean, pivot int, distance double")
    index = checkpointed(index.repartitionByRange(max(1, min(ANNULI, -(-total // ANNULUS_ROWS))), "dim", "pivot", "distance", "vkey").withColumn("annulus", F.spark_partition_id()))
    bounds = index.groupBy("dim", "annulus", "pivot").agg(F.min("distance").alias("inner"), F.max("distance").alias("outer"))
    # ANNULI + PIVOTS rows at most for each length of vectors.
    by_dim: dict[int, list] = {}
    for r in bounds.collect():
        by_dim.setdefault(r.dim, []).append((r.annulus, r.pivot, r.inner, r.outer))
    annuli = spark.sparkContext.broadcast({d: [np.array(c) for c in zip(*sorted(rows), strict=True)] for d, rows in by_dim.items()})

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for at, dim in enumerate(dims.tolist()):
                query = np.asarray(batch.column("vector")[at].values, dtype=float)
                pivots, most, sample, ids = sent.value[dim]
                scores = products(sample, query)
                order = np.argsort(-scores, kind="stable")
                enough = int(np.searchsorted(np.cumsum(ids[order]), k + 1))  # one of them may be the query's own
                floor = float(scores[order[enough]]) if enough < len(order) else -np.inf
                to = np.sqrt(squared(np.append(query, 0.0)[None], pivots))[0]
                room = float(reach(np.float64(floor), query @ query, most)) if floor > -np.inf else np.inf
                own, pivot, inner, outer = annuli.value[dim]
                hit = np.flatnonzero((inner - room <= to[pivot]) & (outer + room >= to[pivot]))
                n = len(hit)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim, np.int32)), pa.array(own[hit].astype(np.int32)), pa.array(pivot[hit].astype(np.int32)), batch.column("vkey").take(pa.array(np.full(n, at))), batch.column("vector").take(pa.array(np.full(n, at))), pa.array(np.full(n, floor)), pa.array(to[pivot[hit]])], names=names)

    names, keys = ["dim", "annulus", "pivot", "vkey", "vector", "floor", "to_pivot"], ["dim", "annulus", "pivot"]
    asked = checkpointed(index.where("asked").select("vkey", "vector", "dim").mapInArrow(ask, "dim int, annulus int, pivot int, vkey long, vector array<double>, floor double, to_pivot double"))
    left, right = in_groups(index.select(*keys, "vkey", "vector", "distance", F.col("ids")[0].alias("least")), asked, keys, GROUP_ROWS, GROUP_QUERIES)

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([("qkey", pa.int64()), ("vkey", pa.int64()), ("score", pa.int64()), ("seen", pa.int64())])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        dim = a.column("dim")[0].as_py()
        a = a.sort_by("distance")
        rows = a.column("vkey").to_numpy(), a.column("least").to_numpy(), stacked(a.column("vector"), dim), a.column("distance").to_numpy()
        found = []
        for qkey, query, floor, to in zip(b.column("vkey").to_pylist(), stacked(b.column("vector"), dim), b.column("floor").to_pylist(), b.column("to_pivot").to_pylist(), strict=True):
            vkeys, scores, seen = search_annulus(*rows, query, floor, to, sent.value[dim][1], k + 1)
            found.append((np.full(len(vkeys) + 1, qkey), np.append(vkeys, -1), np.append(scores, 0), np.append(np.zeros(len(vkeys), np.int64), seen)))
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=schema)

    by = [*keys, "chunk"]
    found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(search, "qkey long, vkey long, score long, seen long")
    if report is not None:
        found = checkpointed(found)
        report.append((found.agg(F.sum("seen")).first()[0] or 0, sum(r.n * r.q for r in sizes)))
    return best_of_each(found.where("vkey >= 0").drop("seen"), index, queries, k)


def _lifted(x: np.ndarray, most: float) -> np.ndarray:
    return np.hstack([x, np.sqrt(np.maximum(most - (x * x).sum(axis=1), 0))[:, None]])
