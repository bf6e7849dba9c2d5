"""Exact Jaccard join of word-shingle sets in metric space.

One less the Jaccard similarity is a metric, so pivots tell what can be near.
A cell is a set of documents that may hold links; it is joined by Voronoi
regions: a few of its documents are pivots, each document belongs to the region
of its nearest pivot, and goes to every other region that the triangle
inequality does not exclude (a document linked to one of region q, at most
``eps`` away, is at most 2 * eps nearer to its own pivot than to q). Documents
far from all pivots have a region of their own, with a window of its own.
Regions are cells again, until they are few enough to compare in full.
Documents that links connect already are never compared, and what is within
``eps`` of a pivot is linked by that distance alone.

The first cells are given by the shingles that links cannot do without: of the
sorted shingles of a set, the first n - ceil(s * n) + 1 hold one of every set
at least s similar. Shingles are sorted by how often they occur (counts in a
bounded table over all documents, from rare to frequent, then by hash), so
passages that many documents share seldom make a cell. A shingle that one set
holds alone makes none, which settles most documents. First each document is
joined in one cell, its largest; then only cells whose members are not all one
component are left, and cells of the same members are one.

Everything is exact but for hashes: shingles are 64 bits, sets 128. Copies of a
set are one. Cells of more than ``LIMIT`` documents, or ``HASHES`` shingles, are
no task's: their pivots go to all slices of the cell, and each slice finds the
regions of its own documents. Where all but a few members are one component
already, the few are the pivots, and there is nothing else to compare. A cell
whose regions hold half of its pairs or more is not split by them: it is cut by
set size, each band with the next, and dealt into pairs of chunks.

A null or empty text, or one without words, has no shingles and is linked with
nothing: it is its own component. Repeated rows each give a row; rows that
repeat an id with another text are documents of their own; null ids are never
the least of a component, and a component of null ids alone has a null one. An
empty table gives an empty result. Columns of any other name do not matter.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import checkpointed, in_parts, map_texts, remove, scratch_path, whole_rows, written
from isobar.llm.components import connected_components
from isobar.llm.simhash import Sets, _folded, _in_parts_of, _of_rows, _sketch, overlaps, runs

#: Documents and shingles of a cell that one task joins.
LIMIT, HASHES = 2_000, 4_000_000
#: Pivots of a cell, and documents that are compared in full without any.
PIVOTS, LEAF = 16, 48
#: Nearest distance beyond which documents are in the far region.
FAR = 0.6
#: A cell whose regions have more than this share of its pairs has not been split.
STUCK = 0.5
#: Counters of shingles: as many as words / WORDS_A_COUNTER, at most 2 ** MOST_BITS.
WORDS_A_COUNTER, MOST_BITS = 256, 22
#: Levels of how often a shingle occurs, for a doubling.
LEVELS = 16

_MIX = np.uint64(0xBF58476D1CE4E5B9)


def shingle_set(text: str, size: int) -> np.ndarray:
    """64-bit hashes of the distinct shingles, sorted: words between ASCII white space, A-Z in lower case; fewer words than ``size`` are one shingle."""
    words = text.encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    own = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    width = min(size, len(own))
    n = len(own) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ own[k : k + n]) * _MIX
        out ^= out >> np.uint64(29)
    return np.unique(out)


def least_common(size: int, percent: int) -> int:
    """Of a set's shingles, how many a set at least ``percent`` similar must share."""
    return -(-percent * size // 100)


def alike(both: np.ndarray | int, a: np.ndarray | int, b: np.ndarray | int, percent: int) -> np.ndarray | bool:
    """Whether sets of a and b shingles that share ``both`` are at least ``percent`` similar, in whole numbers."""
    return 100 * both >= percent * (a + b - both)


def shared_with(pivot: np.ndarray, whole: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many shingles of ``pivot`` each of the sets holds that stand in ``whole``, one behind the other."""
    at = np.searchsorted(pivot, whole)
    at[at == len(pivot)] = 0
    return np.add.reduceat(pivot[at] == whole, starts, dtype=np.int64)


def regions(distances: np.ndarray, eps: float) -> list[np.ndarray]:
    """For each pivot (a row of ``distances``), and last for the far region, which documents are in it or in its window."""
    nearest = distances.min(axis=0)
    reach = np.minimum(nearest + 2 * eps, FAR + eps) + 1e-9
    return [*(distances <= reach), nearest > FAR - eps - 1e-9]


def join_cell(sets: list[np.ndarray], roots: list[int], percent: int) -> list[tuple[int, int]]:
    """Links that connect all similar sets whose roots differ, by Voronoi regions of regions."""
    places = {root: k for k, root in enumerate(dict.fromkeys(roots))}
    known, out, eps = Sets(len(places)), [], 1 - percent / 100
    own = [places[root] for root in roots]
    sizes = np.array([len(x) for x in sets], np.int64)

    def link(i: int, j: int) -> None:
        if known.find(own[i]) != known.find(own[j]):
            known.union(own[i], own[j])
            out.append((i, j))

    def compare(rows: np.ndarray) -> None:
        if len(rows) == 2:
            i, j = rows.tolist()
            low, high = sorted((int(sizes[i]), int(sizes[j])))
            if 100 * low >= percent * high and alike(len(np.intersect1d(sets[i], sets[j], assume_unique=True)), low, high, percent):
                link(i, j)
            return
        both = overlaps([sets[k] for k in rows]).astype(np.int64)
        n = sizes[rows]
        for a, b in np.argwhere(np.triu(alike(both, n[:, None], n[None], percent), 1)).tolist():
            link(int(rows[a]), int(rows[b]))

    stack = [np.arange(len(sets))]
    while stack:
        rows = stack.pop()
        found = np.array([known.find(own[k]) for k in rows.tolist()])
        if len(rows) < 2 or (found == found[0]).all():
            continue
        if len(rows) <= LEAF:
            compare(rows)
            continue
        # Documents of different components, spread over the sizes.
        _, first = np.unique(found, return_index=True)
        first = first[np.argsort(sizes[rows[first]], kind="stable")]
        chosen = first[np.unique(np.linspace(0, len(first) - 1, min(PIVOTS, len(first))).astype(int))]
        whole, starts = np.concatenate([sets[k] for k in rows]), np.concatenate([[0], np.cumsum(sizes[rows])[:-1]])
        distances = np.empty((len(chosen), len(rows)))
        for k, pivot in enumerate(rows[chosen].tolist()):
            both = shared_with(sets[pivot], whole, starts)
            distances[k] = 1 - both / (sizes[rows] + sizes[pivot] - both)
            for i in rows[alike(both, sizes[rows], sizes[pivot], percent)].tolist():
                link(pivot, i)
        # A pivot has been compared with all others.
        rest = np.ones(len(rows), bool)
        rest[chosen] = False
        parts = [rows[part & rest] for part in regions(distances, eps)]
        if sum(len(part) ** 2 for part in parts) > STUCK * len(rows) ** 2:
            left = np.array([known.find(own[k]) for k in rows.tolist()])
            if (left != left[0]).any():
                compare(rows)
        else:
            stack += parts
    return out


def rarity(docs: DataFrame, shingle: int) -> np.ndarray:
    """For each value of a shingle hash's first bits, the level of how many shingles of all documents begin with it: a byte, 128 for the mean.

    A counter holds many shingles, but one that occurs more often than the
    square root of the mean stands out, so levels are fine.
    """
    size = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    bits = min(MOST_BITS, max(10, math.ceil(math.log2(max(1, size / 6 / WORDS_A_COUNTER)))))

    block = 1 << min(12, bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.uint32)
        for batch in in_parts(batches):
            own = [shingle_set(text, shingle) >> np.uint64(64 - bits) for text in batch.column(0).to_pylist()]
            if own:
                np.add.at(counts, np.concatenate(own).astype(np.int64), 1)
        for k, part in enumerate(counts.reshape(-1, block)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)])], names=["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                part = np.frombuffer(zlib.decompress(packed), np.uint32)
                sums[k] = sums[k] + part if k in sums else part.astype(np.int64)
        for k, total in sums.items():
            logs = np.log2(np.maximum(total, 1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([logs.tobytes()])], names=["block", "counts"])

    summed = docs.select("text").mapInArrow(count, "block int, counts binary").repartition("block").mapInArrow(add, "block int, counts binary")
    logs = np.zeros((1 << bits) // block * block, np.float32).reshape(-1, block)
    for row in summed.collect():
        logs[row.block] = np.frombuffer(row.counts, np.float32)
    return np.clip(128 + LEVELS * (logs - np.median(logs)), 0, 255).astype(np.uint8).ravel()


def _described(docs: DataFrame, shingle: int, percent: int, levels: np.ndarray) -> DataFrame:
    """id, rid, set (128 bits), size, prefix and sketch (counts of hashes in buckets) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)
    shift = np.uint64(64 - (len(levels).bit_length() - 1))

    def start():
        rare = shared.value

        def describe(texts: list[str]) -> list:
            keys, sizes, prefixes, sketches = [], [], [], []
            for text in texts:
                own = shingle_set(text, shingle)
                n = len(own) - least_common(len(own), percent) + 1 if len(own) else 0
                order = np.argsort(rare[(own >> shift).astype(np.int64)], kind="stable")[:n]
                keys.append(xxhash.xxh3_128_digest(own.tobytes()))
                sizes.append(len(own))
                prefixes.append(own[order].view(np.int64))
                sketches.append(_sketch(own))
            ends = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.empty(0, np.int64)
            return [keys, sizes, pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)), sketches]

        return describe

    return map_texts(docs, ["id", "rid"], F.col("text"), start, [T.StructField("set", T.BinaryType()), T.StructField("size", T.IntegerType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])


def _whole_sets(classes: DataFrame, described: DataFrame, docs: DataFrame, wanted: DataFrame, shingle: int, broadcast_rows: int, at: str) -> DataFrame:
    """(cls, hashes): the whole sets, little-endian 64-bit hashes in order, of the ``wanted`` classes."""
    rows = checkpointed(classes.select("cls", F.col("first.rid").alias("rid")).join(wanted, "cls", "left_semi"))

    def start():
        return lambda texts: [[shingle_set(text, shingle).astype("<u8").tobytes() for text in texts]]

    texts = _of_rows(docs.select("rid", "text"), rows, "inner", broadcast_rows)
    sets = map_texts(texts, ["cls"], F.col("text"), start, [T.StructField("hashes", T.BinaryType())])
    # Rows repeated in full give their set more than once.
    repeated = described.join(rows, "rid", "left_semi").groupBy("rid").agg(F.count("*").alias("n")).where("n > 1")
    return _kept(sets if repeated.isEmpty() else sets.dropDuplicates(["cls"]), at)


def _sets_of(run: pa.Table, column: str) -> list[np.ndarray]:
    return [np.frombuffer(x, "<u8") for x in run.column(column).to_pylist()]


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*pairs, strict=True) if pairs else ([], []))], names=["a", "b"])


def could_be_alike(roots: np.ndarray, sizes: np.ndarray, sketches: list[np.ndarray], percent: int) -> np.ndarray:
    """Which sets, in order of size, could be similar to one of another root, by sizes and by the least difference that their sketches leave."""
    out, s = np.zeros(len(roots), bool), percent / 100
    ends = np.searchsorted(sizes, sizes / s + 1e-6, "right")
    buckets, level, at, counts = np.array([len(x) for x in sketches]), 0, 0, np.empty((0, 0))
    for i, end in enumerate(ends.tolist()):
        others = i + 1 + np.flatnonzero(roots[i + 1 : end] != roots[i])
        if not len(others):
            continue
        if buckets[i] != level:
            level, at = int(buckets[i]), i
            last = int(ends[np.searchsorted(buckets, level, "right") - 1])
            counts = np.concatenate([_folded(np.stack(list(same)), level) for _, same in groupby(sketches[i:last], len)])
        apart = np.abs(counts[others - at] - counts[i - at]).sum(axis=1, dtype=np.int64)
        near = others[apart <= (int(sizes[i]) + sizes[others]) * ((1 - s) / (1 + s)) + 1e-6]
        if len(near):
            out[i] = out[near] = True
    return out


def _candidates(cells: DataFrame, members: DataFrame, classes: DataFrame, percent: int, at: str) -> DataFrame:
    """The rows of ``cells`` (key, cls, each one task's) that could be linked to one of another root in their cell."""
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            roots = run.column("root").to_numpy()
            if (roots == roots[0]).all():
                continue
            found = could_be_alike(roots, run.column("size").to_numpy(), [np.frombuffer(x, np.uint8) for x in run.column("sketch").to_pylist()], percent)
            if found.any():
                yield pa.RecordBatch.from_arrays([pa.array(run.column(c).to_numpy()[found]) for c in ("key", "cls")], names=["key", "cls"])

    drawn = cells.select("key", "cls").join(members.select("cls", "root"), "cls").join(classes.select("cls", "size", "sketch"), "cls").select("key", "cls", "root", "size", "sketch")
    return _kept(drawn.repartition("key").sortWithinPartitions("key", "size", "cls").mapInArrow(meet, "key long, cls long"), at)


def _joined(cells: DataFrame, members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) of cells (key, cls) that are each one task's."""
    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            ids, roots = run.column("cls").to_pylist(), run.column("root").to_pylist()
            if min(roots) != max(roots):
                yield _links([(ids[i], ids[j]) for i, j in join_cell(_sets_of(run, "hashes"), roots, percent)])

    drawn = cells.select("key", "cls").join(members.select("cls", "root"), "cls").join(sets, "cls").select("key", "cls", "root", "hashes")
    return drawn.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(link, "a long, b long").distinct()


def _sizes(cells: DataFrame, members: DataFrame, limit: int) -> DataFrame:
    """key, n and slices of the cells that are more than one task's."""
    sized = cells.join(members.select("cls", "size"), "cls").groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"))
    return checkpointed(sized.select("key", "n", F.greatest(F.ceil(F.col("n") / limit), F.ceil(F.col("shingles") / HASHES)).alias("slices")).where("slices > 1"))


def _split(rows: DataFrame, members: DataFrame, sets: DataFrame, percent: int, limit: int, at: str) -> DataFrame:
    """What the slices of large cells (key, n, slices, cls) find: links (a, b), or the ``regions`` of a document (parent, the cell it was in, and cls).

    Where all but a few members of a cell have one root, the few are its pivots
    and their links are all that it has. A pivot is compared with every member,
    so it is in no region.
    """
    rows = checkpointed(rows.join(members.select("cls", "root"), "cls"))
    most = rows.groupBy("key", "root").agg(F.count("*").alias("times")).groupBy("key").agg(F.max(F.struct("times", "root")).alias("most"), F.sum("times").alias("all"))
    most = checkpointed(most.select("key", F.col("most.root").alias("main"), (F.col("all") - F.col("most.times") <= limit // 4).alias("few")))
    rows = checkpointed(rows.join(most, "key"))
    seat = F.pmod(F.xxhash64("root", F.lit(3)), F.lit(PIVOTS))
    chosen = rows.where("not few").groupBy("key", seat.alias("seat")).agg(F.min_by(F.struct("cls", "slices", "few"), F.xxhash64("cls")).alias("pivot")).select("key", "pivot.*")
    pivots = chosen.unionByName(rows.where("few AND root <> main").select("key", "cls", "slices", "few"))
    sent = pivots.withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slices") - 1))).withColumn("pivot", F.lit(True))
    dealt = rows.where("not few OR root = main").withColumn("slice", F.pmod(F.xxhash64("cls", F.lit(5)), F.col("slices"))).withColumn("pivot", F.lit(False))
    names = ("key", "cls", "few", "slice", "pivot")
    both = sent.select(*names).unionByName(dealt.select(*names))
    drawn = both.join(members.select("cls", "root"), "cls").join(sets, "cls").select(F.xxhash64("key", "slice").alias("group"), "key", "few", "pivot", "cls", "root", "hashes")
    eps, kinds = 1 - percent / 100, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            key, few = run.column("key")[0].as_py(), run.column("few")[0].as_py()
            ids, roots, is_pivot = (run.column(c).to_numpy() for c in ("cls", "root", "pivot"))
            # A pivot is dealt to a slice as well.
            first = np.ones(len(ids), bool)
            first[np.isin(ids, ids[is_pivot]) & ~is_pivot] = False
            own = [x for x, keep in zip(_sets_of(run, "hashes"), first.tolist(), strict=True) if keep]
            ids, roots, is_pivot = ids[first], roots[first], is_pivot[first]
            chosen, sizes = np.flatnonzero(is_pivot), np.array([len(x) for x in own])
            whole, starts = np.concatenate(own), np.concatenate([[0], np.cumsum(sizes)[:-1]])
            _, places = np.unique(roots, return_inverse=True)
            known, out, distances = Sets(int(places.max()) + 1), [], np.ones((len(chosen), len(ids)))
            for k, p in enumerate(chosen.tolist()):
                shared = shared_with(own[p], whole, starts)
                distances[k] = 1 - shared / (sizes + sizes[p] - shared)
                for i in np.flatnonzero(alike(shared, sizes, sizes[p], percent)).tolist():
                    if known.find(int(places[i])) != known.find(int(places[p])):
                        known.union(int(places[i]), int(places[p]))
                        out.append((ids[p], ids[i], None, None, None))
            if not few:
                named = [xxhash.xxh64_intdigest(f"{key},{name}") >> 1 for name in (*ids[chosen].tolist(), -1)]
                inside = np.stack(regions(distances, eps))
                out += [(None, None, key, ids[i], [named[k] for k in np.flatnonzero(inside[:, i]).tolist()]) for i in np.flatnonzero(~is_pivot).tolist()]
            for k in range(0, len(out), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out[k : k + (1 << 16)], strict=True), kinds, strict=True)], names=["a", "b", "parent", "cls", "regions"])

    return _kept(drawn.repartition("group").sortWithinPartitions("group", "pivot", "cls").mapInArrow(place, "a long, b long, parent long, cls long, regions array<long>"), at)


def _with_roots(members: DataFrame, links: DataFrame, at: str) -> DataFrame:
    """``members`` (cls, size) with the root of each by all ``links``."""
    roots = connected_components(links)
    return _kept(members.select("cls", "size").join(roots.withColumnRenamed("node", "cls"), "cls", "left").withColumn("root", F.coalesce("root", "cls")), at)


def _kept(df: DataFrame, at: str) -> DataFrame:
    """``df`` as a table below ``at``. What a loop hands on is written as a table: a checkpoint keeps its plan's estimate of size, which joins multiply."""
    return written(df, f"{at}/{uuid.uuid4().hex}")


def _mixed(cells: DataFrame, members: DataFrame, at: str) -> DataFrame:
    """``cells`` whose members are not all one component; of cells with the same members, one."""
    own = cells.join(members.select("cls", "root"), "cls")
    same = [F.sum(F.xxhash64("cls", F.lit(k)).cast("decimal(38,0)")).alias(f"s{k}") for k in (1, 2)]
    keys = own.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("n"), *same).where("least <> most")
    keys = checkpointed(keys.groupBy("n", "s1", "s2").agg(F.min("key").alias("key")).select("key"))
    return _kept(cells.join(keys, "key", "left_semi"), at)


def join_cells(cells: DataFrame, members: DataFrame, classes: DataFrame, whole: Callable[[DataFrame], DataFrame], percent: int, limit: int, at: str) -> DataFrame:
    """``members`` (cls, size, root) with the roots that the links of all ``cells`` (key, cls) make of theirs; tables go below ``at``.

    ``whole`` gives the sets of classes. Only sets that bounds do not exclude are asked for.
    """
    links = members.where("root <> cls").select(F.col("cls").alias("a"), F.col("root").alias("b"))
    ratio = F.lit(math.log(1.01 * 100 / percent)).alias("ratio")
    while True:
        large = _sizes(cells, members, limit)
        near = _candidates(cells.join(large, "key", "left_anti"), members, classes, percent, at)
        now = checkpointed(cells.select("key", "cls").join(large, "key"))
        sets = whole(near.select("cls").union(now.select("cls")).distinct())
        links = _kept(links.union(_joined(_mixed(near, members, at), members, sets, percent)), at)
        members = _with_roots(members, links, at)
        if large.isEmpty():
            return members
        found = _split(now, members, sets, percent, limit, at)
        links = _kept(links.union(found.where("a is not null").select("a", "b")), at)
        members = _with_roots(members, links, at)
        placed = found.where("parent is not null").select("parent", "cls", "regions")
        mixed = placed.join(members.select("cls", "root"), "cls").groupBy("parent").agg(F.min("root").alias("least"), F.max("root").alias("most"), F.count("*").alias("rows")).where("least <> most")
        placed = placed.join(checkpointed(mixed.select("parent", "rows")), "parent")
        inside = _kept(placed.select("parent", "cls", "rows", F.explode("regions").alias("key")), at)
        pairs = inside.groupBy("parent", "key").agg(F.count("*").cast("double").alias("n"), F.first("rows").alias("rows")).groupBy("parent").agg(F.sum(F.col("n") * F.col("n")).alias("pairs"), F.first("rows").alias("rows"))
        stuck = checkpointed(pairs.where(F.col("pairs") > STUCK * F.col("rows") * F.col("rows")).select("parent"))
        if not stuck.isEmpty():
            rows = placed.join(stuck, "parent", "left_semi").select(F.col("parent").alias("key"), F.lit(0).alias("k"), "cls").join(members.select("cls", "size"), "cls").withColumn("ratio", ratio)
            dealt = _candidates(_in_parts_of(checkpointed(rows), limit, 1 << 40), members, classes, percent, at)
            dealt = _in_parts_of(checkpointed(dealt.withColumn("k", F.lit(0)).join(members.select("cls", "size"), "cls").select("key", "k", "cls", "size").withColumn("ratio", ratio)), limit, HASHES)
            links = _kept(links.union(_joined(dealt.select("key", "cls"), members, sets, percent)), at)
            members = _with_roots(members, links, at)
        cells = _mixed(inside.join(stuck, "parent", "left_anti").select("key", "cls"), members, at)


def jaccard_components(docs: DataFrame, shingle: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text", limit: int = LIMIT, broadcast_rows: int = 1_000_000) -> DataFrame:
    """Each row's id, n_shingles (the size of its set) and component_id: the smallest id reachable over links, its own included.

    Two documents link when 100 * intersection >= ``percent`` * union of their
    sets of distinct ``shingle``-word shingles.
    """
    rows = whole_rows(docs, id_col, text_col, carry=()).drop("doc")
    at = scratch_path(docs.sparkSession, "jaccard")
    described = checkpointed(_described(rows, shingle, percent, rarity(rows, shingle)))
    first = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"), F.col("rid").alias("rid"))).alias("first")
    classes = described.where("size > 0").groupBy("set").agg(first, *[F.first(c).alias(c) for c in ("size", "prefix", "sketch")])
    classes = _kept(classes.withColumn("cls", F.monotonically_increasing_id()), at)
    keyed = classes.select("cls", F.explode("prefix").alias("key"))
    times = _kept(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), at)
    cells = _kept(keyed.join(times, "key"), at)
    members = _kept(classes.select("cls", "size", F.col("cls").alias("root")).join(cells.select("cls").distinct(), "cls", "left_semi"), at)
    home = _kept(cells.groupBy("cls").agg(F.max(F.struct("n", "key")).alias("home")).select(F.col("home.key").alias("key"), "cls"), at)

    def whole(wanted: DataFrame) -> DataFrame:
        return _whole_sets(classes, described, rows, wanted, shingle, broadcast_rows, at)

    members = join_cells(home, members, classes, whole, percent, limit, at)
    members = join_cells(_mixed(cells.select("key", "cls"), members, at), members, classes, whole, percent, limit, at)

    least = classes.select("set", "cls", "first").join(members.select("cls", "root"), "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    ids = least.groupBy("root").agg(F.min("first").alias("first")).select("root", F.col("first.id").alias("component_id"))
    # Written first, so that both sides of the join are plain exchanges and a set that many rows share is split.
    of_set = checkpointed(least.join(ids, "root").select("set", "component_id"))
    remove(docs.sparkSession, at)
    out = described.where("size > 0").select("id", "size", "set").join(of_set, "set").select("id", "size", "component_id")
    out = out.unionByName(described.where("size = 0").select("id", "size", F.col("id").alias("component_id")))
    return out.select(F.col("id").alias(id_col), F.col("size").cast("long").alias("n_shingles"), "component_id")
