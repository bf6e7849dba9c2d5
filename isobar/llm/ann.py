"""Approximate nearest neighbours by multi-index hashing.

Codes are the signs of learned rotations (each fitted so that the signs lose
little of the vectors, one after the other from another random start), cut
into substrings of 16 bits, each with a table of its own. Two codes that are
less than tables * (reach + 1) bits apart agree in one substring up to
``reach`` bits, so probing every table at that distance finds all of that
Hamming ball, and many codes beyond it.

Each query has its own reach and its own radius. Probing starts at a small
reach; the distance of the (k + 1)-th nearest code found (the query's own is
one of them) then tells which reach finds codes at that distance, and a query
that was not probed so far is probed once more at it. Its radius is that
distance and ``slack`` bits; what lies within is reranked by the exact cosine.
So a query is compared with what lies about its k nearest, in small tables and
large ones, and a group sends on only what is within the radius known from the
probe before or seen in the group itself, neither of which is ever too small.

The tables are groups of the cluster: a code is sent to each table's bucket,
the leading bits of its substring, and a query only to the buckets within
its reach, where it probes the bucket's sorted substrings. What is sent grows
with rows and with queries, not with their product; buckets that hold too many
are cut, and copies are one code (``vectors``).

Rotations come from at most ``SAMPLE`` rows. How many tables, how sure a reach
must be and how many bits of slack are then chosen by recall: ``CALIBRATION``
of these rows get their true neighbours, and the distance of their (k + 1)-th
nearest code, among *all* rows by one pass of brute force; of all choices that
find ``RECALL`` of the neighbours, the one that looks at the fewest rows is
taken. Every row is indexed. Queries that find fewer than k + 1 vectors probe
again at a larger reach, at last everywhere; a query is not widened because
its k rows are poor, only because codes as far as they may have been missed.

Vectors that are null, zero, or hold null or non-finite components take no
part, nor do rows with a null id; vectors of different lengths do not meet.
Ties go to the smaller id. Copies are found like any other vector; a row that
is repeated in full counts once; an id with several vectors takes part with
each, and is never its own neighbour. Fewer candidates than k give fewer rows,
an empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import checkpointed
from isobar.llm.vectors import best_of_each, bounded_sample, distinct_vectors, in_groups, spread, stacked, whole_vectors

BITS, TABLES = 16, 24
SAMPLE, CALIBRATION = 2_048, 128
RECALL = 0.985
#: The part of the neighbours that the radius of a query may leave out.
BEYOND = 0.01
#: Codes that the first probe is to find for each row wanted.
FIRST = 40
#: How sure a reach may have to find a code at the distance of the last one needed.
LEVELS = (0.5, 0.7, 0.8, 0.9, 0.95, 0.98, 0.99, 0.999, 1.0)
#: Rows of a bucket, about; and most rows and queries of a group.
BUCKET_ROWS, GROUP_ROWS, GROUP_QUERIES = 4_096, 32_768, 4_096
#: Queries that are compared with a group at once.
TOGETHER = 64
#: Most components of all queries' vectors that are broadcast; beyond it both sides are shuffled.
BROADCAST_COMPONENTS = 2_000_000


def unit(x: np.ndarray) -> np.ndarray:
    """Each row over its length, scaled first so that no square overflows or vanishes."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def learn_rotations(sample: np.ndarray, bits: int = TABLES * BITS, rounds: int = 20, seed: int = 3) -> np.ndarray:
    """dimension x bits: orthogonal maps whose signs stay close to the rotated vectors."""
    dim, rng, out = sample.shape[1], np.random.default_rng(seed), []
    for _ in range(-(-bits // dim)):
        turn = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
        for _ in range(rounds if len(sample) >= dim else 0):
            left, _, right = np.linalg.svd(sample.T @ np.where(sample @ turn >= 0, 1.0, -1.0))
            turn = left @ right
        out.append(turn)
    return np.hstack(out)[:, :bits]


def codes_of(x: np.ndarray, turns: np.ndarray) -> np.ndarray:
    """rows x tables, an unsigned 16-bit substring each."""
    return np.packbits(x @ turns >= 0, axis=1).view(">u2").astype(np.uint16)


def apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ, for each substring."""
    return np.bitwise_count(a ^ b)


class Plan(NamedTuple):
    """How one length of vectors is searched."""

    turns: np.ndarray
    tables: int
    #: For each reach the greatest distance of whole codes at which it finds enough of them.
    sure: np.ndarray
    #: Reach of the first probe.
    reach: int
    #: Bits that a query's radius has beyond its (k + 1)-th nearest code.
    slack: int
    bucket_bits: int
    recall: float
    share: float


def sure_distances(tables: int, level: float) -> np.ndarray:
    """For each reach the greatest distance of two codes at which one table at least finds them with probability ``level``.

    Bits that differ are taken to fall anywhere in the code; the ball that the
    pigeonhole principle covers is always part of it.
    """
    bits = BITS * TABLES
    share = np.arange(bits + 1) / bits
    ways = np.array([math.comb(BITS, j) for j in range(BITS + 1)])
    within = np.cumsum([w * share**j * (1 - share) ** (BITS - j) for j, w in enumerate(ways)], axis=0)
    missed = np.clip(1 - within, 0, 1) ** tables
    by_chance = ((1 - missed >= level).cumprod(axis=1).sum(axis=1) - 1) if level < 1 else np.zeros(BITS + 1, np.int64)
    by_chance[BITS] = bits
    return np.minimum(bits, np.maximum(by_chance, tables * (np.arange(BITS + 1) + 1) - 1))


def choose(near: list[np.ndarray], far: list[np.ndarray], last: np.ndarray, enough: float, recall: float = RECALL) -> tuple[int, np.ndarray, int, int, float, float]:
    """Tables, sure distances, first reach and slack, with the recall and the share of rows probed that they give.

    ``near`` and ``far`` hold, for each query of the calibration, the bits by
    which its true neighbours and the sample's rows differ, by substring;
    ``last`` the distance of its (k + 1)-th nearest code among all rows. The
    first reach is the smallest at which nine in ten queries find ``enough`` of
    the sample, unless that spares too little of the work of the second.
    """
    sizes = [len(a) for a in near]
    if not sum(sizes):
        return 1, sure_distances(1, 1.0), BITS, BITS * TABLES, 1.0, 1.0
    close, others = np.concatenate(near), np.concatenate(far)
    beyond = close.sum(axis=1, dtype=np.int64) - np.repeat(last, sizes)
    slack = max(0, int(np.ceil(np.quantile(beyond, 1 - BEYOND))))
    best = None
    for tables in (TABLES * 2 // 3, TABLES):
        least, least_far = close[:, :tables].min(axis=1), others[:, :tables].min(axis=1)
        for level in LEVELS:
            sure = sure_distances(tables, level)
            needed = np.searchsorted(sure, last)
            middle = int(np.median(needed))
            first = next((r for r in range(middle) if np.mean([(a[:, :tables].min(axis=1) <= r).sum() >= enough for a in far]) >= 0.9), middle)
            if (least_far <= first).mean() > (least_far <= middle).mean() / 4:
                first = middle
            reach = np.maximum(needed, first)
            found = float(((least <= np.repeat(reach, sizes)) & (beyond <= slack)).mean())
            if found >= recall or level == LEVELS[-1]:
                share = float((least_far <= np.repeat(reach, [len(a) for a in far])).mean())
                # sending a code to another table costs something, too
                cost = share + tables * 2e-3
                if best is None or cost < best[0]:
                    best = cost, tables, sure, first, slack, found, share
                break
    return best[1:]


def probe(codes: np.ndarray, query: np.ndarray, table: int, reach: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, bits that differ) of all codes that agree with a query in this table up to its ``reach`` bits, and in no table before it.

    ``codes`` are in the order of this table's substring, so each distinct
    substring is compared once and stands for a run of rows.
    """
    own = codes[:, table]
    starts = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])) if len(own) else np.empty(0, np.int64)
    ends = np.append(starts[1:], len(own))
    at_query, at_run = np.nonzero(apart(query[:, table, None], own[starts][None]) <= reach[:, None])
    lengths = (ends - starts)[at_run]
    rows = np.repeat(starts[at_run] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum()) if len(lengths) else np.empty(0, np.int64)
    asked = np.repeat(at_query, lengths)
    bits = apart(query[asked], codes[rows])
    keep = (bits[:, :table] > reach[asked, None]).all(axis=1)
    return asked[keep], rows[keep], bits[keep].sum(axis=1, dtype=np.int64)


def within_radius(asked: np.ndarray, bits: np.ndarray, wanted: int, slack: int) -> np.ndarray:
    """Which (query, bits) lie within ``slack`` of the query's ``wanted``-th smallest; all of a query with fewer."""
    order = np.lexsort((bits, asked))
    sorted_ = asked[order]
    start = np.searchsorted(sorted_, sorted_)
    last = start + wanted - 1
    end = np.searchsorted(sorted_, sorted_, side="right")
    limit = np.where(last < end, bits[order][np.minimum(last, len(order) - 1)] + slack, BITS * TABLES) if len(order) else np.empty(0, np.int64)
    keep = np.zeros(len(order), bool)
    keep[order] = bits[order] <= limit
    return keep


def learn(vectors: DataFrame, n: int, dim: int, k: int) -> Plan:
    """Rotations from a bounded sample, and tables, reach and radius by the recall that they have over all rows."""
    sample = unit(stacked(bounded_sample(vectors, n, SAMPLE).select("vector").toArrow().column(0), dim)) if n else np.zeros((0, dim))
    asked = np.arange(len(sample)) % max(1, len(sample) // CALIBRATION) == 0
    # The rows that measure recall are not among those that the rotations fit, if there are others.
    turns = learn_rotations(sample[~asked] if len(sample) >= 4 * CALIBRATION else sample)
    queries = sample[asked][:CALIBRATION]

    own = codes_of(queries, turns)

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cosine, rows, bits = np.zeros((len(queries), 0)), np.zeros((0, dim)), np.zeros((len(queries), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = unit(stacked(batch.column(0), dim))
            rows, cosine = np.vstack([rows, x]), np.hstack([cosine, queries @ x.T])
            used = np.unique(np.argsort(-cosine, axis=1, kind="stable")[:, : k + 1])
            rows, cosine = rows[used], cosine[:, used]
            codes = codes_of(x, turns)
            new = np.array([apart(codes, q).sum(axis=1, dtype=np.int64) for q in own])
            bits = np.sort(np.hstack([bits, new]), axis=1)[:, : k + 1]
        found = [(q, float(cosine[q, r]), rows[r].tolist(), None) for q in range(len(queries)) for r in np.argsort(-cosine[q], kind="stable")[: k + 1].tolist()]
        found += [(q, None, None, b) for q in range(len(queries)) for b in bits[q].tolist()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else [()] * 4, (pa.int32(), pa.float64(), pa.list_(pa.float64()), pa.int32()), strict=True)], names=["q", "cosine", "x", "bits"])

    seen = checkpointed(vectors.select("vector").mapInArrow(nearest, "q int, cosine double, x array<double>, bits int"))
    place = lambda *order: F.row_number().over(Window.partitionBy("q").orderBy(*order))
    true = seen.where("x IS NOT NULL").withColumn("place", place(F.desc("cosine"), "x")).where(F.col("place").between(2, k + 1))
    near: list[list] = [[] for _ in queries]
    for r in true.select("q", "x").collect():  # CALIBRATION * k rows at most
        near[r.q].append(r.x)
    last = np.zeros(len(queries), np.int64)
    for r in seen.where("bits IS NOT NULL").withColumn("place", place("bits")).where(F.col("place") <= k + 1).groupBy("q").agg(F.max("bits").alias("last")).collect():
        last[r.q] = r["last"]
    codes = codes_of(sample, turns)
    close = [apart(codes_of(np.array(x).reshape(-1, dim), turns), own[q]) for q, x in enumerate(near)]
    tables, sure, reach, slack, recall, share = choose(close, [apart(codes, c) for c in own], last, FIRST * (k + 1) * len(sample) / max(n, 1))
    return Plan(turns, tables, sure, reach, slack, spread(n, BUCKET_ROWS, 1 << BITS), recall, share)


def candidates(index: DataFrame, queries: DataFrame, plans: dict[int, Plan], wanted: int) -> DataFrame:
    """(qkey, vkey, bits) of what probing finds within each query's radius as its group sees it.

    ``index`` has vkey, dim and code, ``queries`` also the reach and the
    radius known so far of each.
    """
    sent = index.sparkSession.sparkContext.broadcast({d: (p.tables, p.slack, p.bucket_bits) for d, p in plans.items()})

    def buckets_of(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """dim, reach, rows, their buckets in each table, and the masks to probe beside them; rows of the index have reach 0."""
        dims, reaches = batch.column(1).to_numpy(), batch.column(3).to_numpy()
        for dim, reach in sorted({*zip(dims.tolist(), reaches.tolist(), strict=True)}):
            tables, _, width = sent.value[dim]
            rows = np.flatnonzero((dims == dim) & (reaches == reach))
            codes = np.frombuffer(b"".join(batch.column(2).take(pa.array(rows)).to_pylist()), np.uint16).reshape(len(rows), -1)
            masks = np.arange(1 << width) if reach else np.zeros(1, np.int64)
            yield dim, reach, rows, codes[:, :tables].astype(np.int64) >> (BITS - width), masks[np.bitwise_count(masks) <= reach]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, reach, rows, buckets, masks in buckets_of(batch):
                step = 1 + (1 << 16) // len(masks)
                for table in range(buckets.shape[1]):
                    for at in range(0, len(rows), step):
                        bucket = (buckets[at : at + step, table, None] ^ masks[None]).ravel()
                        of = pa.array(np.repeat(rows[at : at + step], len(masks)))
                        n = len(of)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim, np.int32)), pa.array(np.full(n, table, np.int32)), pa.array(bucket.astype(np.int32)), batch.column(0).take(of), batch.column(2).take(of), pa.array(np.full(n, reach, np.int32)), batch.column(4).take(of)], names=["dim", "table", "bucket", "vkey", "code", "reach", "radius"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for dim, _, _, buckets, masks in buckets_of(batch):
                n = 1 << sent.value[dim][2]
                for table in range(buckets.shape[1]):
                    own = np.bincount(buckets[:, table], minlength=n)
                    held[dim, table] = held.get((dim, table), 0) + own[np.arange(n)[:, None] ^ masks[None]].sum(axis=1)
        for (dim, table), own in held.items():
            some = np.flatnonzero(own)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), dim, np.int32)), pa.array(np.full(len(some), table, np.int32)), pa.array(some.astype(np.int32)), pa.array(own[some])], names=["dim", "table", "bucket", "rows"])

    sides = index.select("vkey", "dim", "code", F.lit(0).alias("reach"), F.lit(0).alias("radius")), queries.select("vkey", "dim", "code", F.col("reach").cast("int"), F.col("radius").cast("int"))
    keys = ["dim", "table", "bucket"]
    left, right = (df.mapInArrow(deal, "dim int, table int, bucket int, vkey long, code binary, reach int, radius int") for df in sides)
    sizes = tuple(df.mapInArrow(count, "dim int, table int, bucket int, rows long") for df in sides)
    left, right = in_groups(left.drop("reach", "radius"), right, keys, GROUP_ROWS, GROUP_QUERIES, sizes)

    def search(a: pa.Table, b: pa.Table) -> pa.Table:
        schema = pa.schema([("qkey", pa.int64()), ("vkey", pa.int64()), ("bits", pa.int32())])
        if not a.num_rows or not b.num_rows:
            return schema.empty_table()
        _, slack, _ = sent.value[a.column("dim")[0].as_py()]
        table = a.column("table")[0].as_py()
        of = lambda t: (t.column("vkey").to_numpy(), np.frombuffer(b"".join(t.column("code").to_pylist()), np.uint16).reshape(t.num_rows, -1))
        (ids, codes), (asked, own) = of(a), of(b)
        reach, radius = b.column("reach").to_numpy(), b.column("radius").to_numpy()
        order = np.argsort(codes[:, table], kind="stable")
        ids, codes = ids[order], codes[order]
        found = []
        for at in range(0, len(asked), TOGETHER):
            q, r, bits = probe(codes, own[at : at + TOGETHER], table, reach[at : at + TOGETHER])
            keep = (bits <= radius[at + q]) & within_radius(q, bits, wanted, slack)
            found.append((asked[at + q[keep]], ids[r[keep]], bits[keep].astype(np.int32)))
        return pa.table([np.concatenate(c) for c in zip(*found, strict=True)], schema=schema)

    by = [*keys, "chunk"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(search, "qkey long, vkey long, bits int")


def _scored(pairs: DataFrame, index: DataFrame, asked: DataFrame) -> DataFrame:
    """The pairs with the exact cosine; ``asked`` has the queries' vectors, which travel to the pairs where they are counted to be few."""
    few = (asked.agg(F.sum("dim")).first()[0] or 0) <= BROADCAST_COMPONENTS
    asked = F.broadcast(asked) if few else asked
    dot = F.aggregate(F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return pairs.join(index.select("vkey", F.col("unit").alias("x")), "vkey").join(asked.select(F.col("vkey").alias("qkey"), F.col("unit").alias("y")), "qkey").select("qkey", "vkey", dot.alias("score"))


def nearest_by_cosine(df: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", report: list | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's k nearest among all other rows.

    ``is_query`` is a condition on the column ``id``. ``report`` gets the plan
    of each length of vectors, with its measured recall and share probed.
    """
    spark = df.sparkSession
    whole = whole_vectors(df, id_col, vector_col).where(F.exists("vector", lambda x: x != 0))
    distinct, queries = distinct_vectors(whole, is_query, k)
    sizes = {r.dim: r.n for r in distinct.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    plans = {dim: learn(distinct.where(F.col("dim") == dim), n, dim, k) for dim, n in sizes.items()}
    if report is not None:
        report += plans.values()
    turns = spark.sparkContext.broadcast({dim: p.turns for dim, p in plans.items()})

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            units, codes = np.empty(batch.num_rows, object), np.empty(batch.num_rows, object)
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                x = unit(stacked(batch.column("vector").take(pa.array(rows)), dim))
                for row, own, code in zip(rows.tolist(), x, codes_of(x, turns.value[dim]), strict=True):
                    units[row], codes[row] = own, code.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.select(["vkey", "dim", "ids", "asked"]).columns, pa.array(list(units), pa.list_(pa.float64())), pa.array(codes, pa.binary())], names=["vkey", "dim", "ids", "asked", "unit", "code"])

    index = checkpointed(distinct.mapInArrow(coded, "vkey long, dim int, ids array<long>, asked boolean, unit array<double>, code binary"))
    asked, done, out = checkpointed(index.where("asked").select("vkey", "dim", "code", "unit")), [], None
    model = F.broadcast(spark.createDataFrame([(d, min(k + 1, n), plans[d].reach, plans[d].slack, plans[d].sure.tolist()) for d, n in sizes.items()], "dim int, wanted int, first int, slack int, sure array<int>"))
    left = checkpointed(asked.drop("unit").join(model, "dim").withColumn("reach", F.col("first")).withColumn("radius", F.lit(BITS * TABLES)))
    nearest = Window.partitionBy("qkey").orderBy("bits")
    while True:
        found = checkpointed(candidates(index, left, plans, k + 1))
        last = found.withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1).groupBy(F.col("qkey").alias("vkey")).agg(F.max("place").alias("got"), F.max("bits").alias("last"))
        # The reach that finds codes as far as the last one needed; without enough codes, a larger one.
        needed = F.when(F.col("got") >= F.col("wanted"), F.size(F.filter("sure", lambda s: s < F.col("last")))).otherwise(F.col("reach") + 2)
        state = checkpointed(left.join(last, "vkey", "left").withColumn("needed", F.least(F.lit(BITS), needed)))
        ready = F.col("reach") >= F.col("needed")
        state = state.withColumn("radius", F.when(F.col("got") > k, F.col("last") + F.col("slack")).otherwise(BITS * TABLES))
        done.append(found.join(state.where(ready).select(F.col("vkey").alias("qkey"), "radius"), "qkey").where("bits <= radius").select("qkey", "vkey"))
        left = checkpointed(state.where(~ready).withColumn("reach", F.col("needed")).drop("got", "last", "needed"))
        if left.isEmpty():
            break
    for pairs in done:
        out = pairs if out is None else out.unionByName(pairs)
    return best_of_each(_scored(out, index, asked), index, queries, k)
