"""SimHash near-duplicates through BK-trees.

A fingerprint's bits are the majority over a text's word shingles. Two
fingerprints at most ``radius`` bits apart are linked; components of links are
the classes.

Sharding: of ``radius + 1`` blocks of bits two linked fingerprints share one,
and of ``radius + 1`` blocks of the other bits they share one again, so every
link lies in a shard of fingerprints with both blocks equal (16 keys of 28 bits
each for radius 3). Copies are one fingerprint before that. A shard that is
still larger than ``SHARD_LIMIT`` is cut by its root: a BK-tree keys children
by their distance to the parent, linked fingerprints differ by the radius at
most in it, so bands of distances, each with the next, hold every link. What is
still larger is dealt into pairs of chunks.

In a shard a BK-tree is built and only edges within the radius are followed.
What a shard gives is one link from each linked member to its least one, so a
group of n gives n rows and not n * n. The trees are partition-local and not
broadcast, as they grow with the corpus.

Nulls and ties: a null text counts as empty, a text without words has
fingerprint zero, linked like any other. Null ids are never the smallest of a
class; a class without ids has a null component. Repeated rows each give a
row. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import checkpointed, in_parts, map_texts, text_or_empty, whole_rows
from isobar.llm.components import connected_components

SEED = 42
SHARD_LIMIT = 4_096


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of the shingles of words between ASCII white space, A-Z in lower case; repeats included."""
    words = text.encode().lower().split()
    if len(words) <= size:
        shingles = [b" ".join(words)] if words else []
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(size)], strict=False))
    return np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(counts * 2 > len(hashes)))


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


class BKTree:
    """Children are keyed by their distance to the parent."""

    def __init__(self) -> None:
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> int:
        self.values.append(value)
        self.children.append({})
        new, at = len(self.values) - 1, 0
        while new:
            d = (self.values[at] ^ value).bit_count()
            if d not in self.children[at]:
                self.children[at][d] = new
                break
            at = self.children[at][d]
        return new

    def within(self, value: int, radius: int) -> list[int]:
        out, stack = [], [0] if self.values else []
        while stack:
            at = stack.pop()
            d = (self.values[at] ^ value).bit_count()
            if d <= radius:
                out.append(at)
            stack += [child for edge, child in self.children[at].items() if d - radius <= edge <= d + radius]
        return out


class Sets:
    """Disjoint sets of 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def linked(values: list[int], radius: int, alike: Callable[[int, int], bool] | None = None) -> list[int]:
    """For each value, the first value of its group in this shard; ``alike`` confirms a link."""
    tree, sets = BKTree(), Sets(len(values))
    for k, value in enumerate(values):
        for other in tree.within(value, radius):
            if sets.find(other) != sets.find(k) and (alike is None or alike(other, k)):
                sets.union(other, k)
        tree.add(value)
    return [sets.find(k) for k in range(len(values))]


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The runs of two or more rows with equal first column, from batches in its order."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for start, end in zip(cuts, cuts[1:], strict=False):
            if held and held[0].column(0)[0].as_py() != keys[start]:
                if sum(map(len, held)) > 1:
                    yield pa.Table.from_batches(held)
                held = []
            if not held and end < len(keys) and end - start == 1:
                continue  # a run of one that ends here
            held.append(batch.slice(start, end - start))
    if sum(map(len, held)) > 1:
        yield pa.Table.from_batches(held)


def shard_keys(fp: Column, radius: int) -> Column:
    """The keys, array<long>, of the shards of a 64-bit fingerprint."""
    n = radius + 1

    def cut(bits: list[int]) -> list[list[int]]:
        return [list(map(int, part)) for part in np.array_split(bits, n)]

    def packed(bits: list[int]) -> Column:
        low = 0
        out = F.lit(0).cast("long")
        for start, end in _stretches(bits):
            width = end - start
            out = out.bitwiseOR(F.shiftleft(F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1).cast("long")), low))
            low += width
        return out

    keys = []
    for block in cut(list(range(64))):
        rest = [b for b in range(64) if b not in block]
        keys += [packed(sorted(block + inner)) for inner in cut(rest)]
    return F.array(*[F.xxhash64(F.lit(k), key) for k, key in enumerate(keys)])


def _stretches(bits: list[int]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for b in bits:
        if out and out[-1][1] == b:
            out[-1] = out[-1][0], b + 1
        else:
            out.append((b, b + 1))
    return out


def split_large(keyed: DataFrame, member: str, limit: int) -> DataFrame:
    """``keyed`` with the groups of more than ``limit`` rows dealt into pairs of chunks, so that any two rows of a group still meet.

    A group of m chunks becomes a group for each pair of chunks, and a row goes
    to the m - 1 pairs of its own chunk: n * n / limit rows for a group of n,
    which only distinct fingerprints that agree in 28 bits and in their distance
    to the root can make.
    """
    large = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit))
    if large.isEmpty():
        return keyed
    chunks = F.ceil(F.col("n") / limit)
    joined = keyed.join(large, "key", "left").withColumn("chunk", F.pmod(F.xxhash64(member, F.lit(SEED)), chunks))
    pairs = F.transform(F.filter(F.sequence(F.lit(0).cast("long"), chunks - 1), lambda x: x != F.col("chunk")), lambda x: F.xxhash64("key", F.least(x, F.col("chunk")), F.greatest(x, F.col("chunk"))))
    return joined.withColumn("key", F.explode(F.when(F.col("n").isNull(), F.array("key")).otherwise(pairs))).drop("n", "chunk")


def hamming_links(fingerprints: DataFrame, radius: int = 3, shard_limit: int = SHARD_LIMIT) -> DataFrame:
    """Links (a, b) that connect all of the distinct ``fp`` (long) at most ``radius`` bits apart."""
    keyed = fingerprints.select("fp", F.explode(shard_keys(F.col("fp"), radius)).alias("key"))
    large = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("fp").alias("root")).where(F.col("n") > shard_limit).drop("n"))
    if not large.isEmpty():
        band = F.floor(F.bit_count(F.col("fp").bitwiseXOR(F.col("root"))) / (radius + 1))
        keyed = keyed.join(large, "key", "left").select("fp", F.explode(F.when(F.col("root").isNull(), F.array("key")).otherwise(F.array(F.xxhash64("key", band), F.xxhash64("key", band + 1)))).alias("key"))
        keyed = split_large(keyed.select("key", "fp").distinct(), "fp", shard_limit)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            fps = run.column(1).to_pylist()
            firsts = linked([fp & (1 << 64) - 1 for fp in fps], radius)
            pairs = [(fps[k], fps[first]) for k, first in enumerate(firsts) if k != first]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], names=["a", "b"])

    return keyed.select("key", "fp").repartition("key").sortWithinPartitions("key", "fp").mapInArrow(link, "a long, b long")


def fingerprints(docs: DataFrame, shingle: int = 3, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` and fp (long, the 64 bits) of every row."""

    def start():
        return lambda texts: [[signed(majority(shingle_hashes(text, shingle))) for text in texts]]

    return map_texts(docs, keep, text_or_empty(text_col), start, [T.StructField("fp", T.LongType())])


def simhash_classes(docs: DataFrame, shingle: int = 3, radius: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, fp and component_id: the smallest id reachable over links, its own included."""
    prints = checkpointed(fingerprints(docs, shingle, text_col, (id_col,)))
    distinct = checkpointed(prints.groupBy("fp").agg(F.min(id_col).alias("least")))
    roots = connected_components(hamming_links(distinct, radius)).withColumnRenamed("node", "fp")
    grouped = checkpointed(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = grouped.join(least, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(id_col, "fp", "component_id")


# --- near-duplicates by shingle similarity --------------------------------

#: Minima of a set's hashes by which sets meet: two of similarity 0.8 share none of them once in 1.5e11 pairs, more similar ones less often.
MINIMA = 16
#: Bits between fingerprints of shingle sets that are compared at once: at a similarity of 0.8 they differ in 10, with a deviation of 3. What lies beyond is found in the second round.
SIMILAR_RADIUS = 16
#: Sets under one key that are compared in one task.
KEY_LIMIT = 2_000
#: Hashes of all the whole sets that are compared in one task.
GROUP_HASHES = 4_000_000
#: Sets of a larger group that go to all of its parts.
AMBASSADORS = 32
#: A set's hashes are counted in a power of two of buckets, this many or up to twice as many in one; what two sets' counts differ by, the sets differ by at least.
BUCKET_HASHES = 2

_RNG = np.random.default_rng(SEED)
_FACTORS = _RNG.integers(0, 1 << 63, (MINIMA, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MASKS = _RNG.integers(0, 1 << 63, (MINIMA, 1), dtype=np.uint64)


def _minima(own: np.ndarray) -> np.ndarray:
    if not len(own):
        return np.zeros(MINIMA, np.int64)
    out = np.full(MINIMA, np.iinfo(np.uint64).max)
    for at in range(0, len(own), 1 << 16):
        out = np.minimum(out, ((own[None, at : at + (1 << 16)] ^ _MASKS) * _FACTORS).min(axis=1))
    return out.view(np.int64)


def _sketch(own: np.ndarray) -> bytes:
    buckets = 1 << max(5, (len(own) // BUCKET_HASHES).bit_length() - 1)
    return np.minimum(np.bincount((own % np.uint64(buckets)).astype(np.int64), minlength=buckets), 255).astype(np.uint8).tobytes()


def _folded(counts: np.ndarray, buckets: int) -> np.ndarray:
    """Rows of counts in more buckets, as counts in ``buckets``."""
    return counts.reshape(len(counts), -1, buckets).sum(axis=1, dtype=np.int16)


def similar(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether two sets (sorted, without repeats) have a Jaccard similarity of ``least`` or more."""
    if min(len(a), len(b)) < least * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= least * (len(a) + len(b) - both)


def _described(docs: DataFrame, shingle: int) -> DataFrame:
    """Each row's id, rid, 128-bit hash of its shingle set, fp, minima, set size and sketch."""

    def start():
        def describe(texts: list[str]) -> list:
            sets, fps, minima, sizes, sketches = [], [], [], [], []
            for text in texts:
                own = np.unique(shingle_hashes(text, shingle))
                sets.append(xxhash.xxh3_128_digest(own.tobytes()))
                fps.append(signed(majority(own)))
                minima.append(_minima(own))
                sizes.append(len(own))
                sketches.append(_sketch(own))
            return [sets, fps, minima, sizes, sketches]

        return describe

    kinds = [T.StructField("set", T.BinaryType()), T.StructField("fp", T.LongType()), T.StructField("minima", T.ArrayType(T.LongType())), T.StructField("size", T.IntegerType()), T.StructField("sketch", T.BinaryType())]
    return map_texts(docs, ["id", "rid"], F.col("text"), start, kinds)


def _of_rows(docs: DataFrame, rids: DataFrame, how: str, broadcast_rows: int) -> DataFrame:
    """The rows of ``docs`` in (or not in) ``rids``; these are broadcast only if counted to be few, else both sides are shuffled."""
    return docs.join(F.broadcast(rids) if rids.count() <= broadcast_rows else rids.hint("merge"), "rid", how)


def _classes(described: DataFrame) -> DataFrame:
    """A row for each distinct shingle set: cls (a number), its first row, and what describes it."""
    own = [F.first(c).alias(c) for c in ("fp", "minima", "size", "sketch")]
    first = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"), F.col("rid").alias("rid")))
    return described.groupBy("set").agg(first.alias("first"), *own).drop("set").withColumn("cls", F.monotonically_increasing_id())


def _sets(classes: DataFrame, docs: DataFrame, wanted: DataFrame, shingle: int, broadcast_rows: int) -> DataFrame:
    """(cls, hashes): the whole sets, as sorted little-endian 64-bit hashes, of the ``wanted`` classes."""
    rows = checkpointed(classes.select("cls", F.col("first.rid").alias("rid")).join(wanted, "cls", "left_semi"))

    def start():
        return lambda texts: [[np.unique(shingle_hashes(text, shingle)).astype("<u8").tobytes() for text in texts]]

    texts = _of_rows(docs.select("rid", "text"), rows, "inner", broadcast_rows)
    return map_texts(texts, ["cls"], F.col("text"), start, [T.StructField("hashes", T.BinaryType())]).dropDuplicates(["cls"])


def _ambassadors(keyed: DataFrame, limit: int) -> DataFrame:
    """``keyed`` (key, cls) with groups of more than ``limit`` rows dealt into parts; ``AMBASSADORS`` of the group go to all of them, so that what is like these becomes one class."""
    large = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > limit))
    if large.isEmpty():
        return keyed
    parts = F.ceil(F.col("n") / limit)
    dealt = keyed.join(large, "key", "left").withColumn("key", F.when(F.col("n").isNull(), F.col("key")).otherwise(F.xxhash64("key", F.pmod(F.xxhash64("cls", F.lit(SEED)), parts)))).drop("n")
    sent = keyed.join(large, "key").groupBy("key", F.pmod(F.xxhash64("cls", F.lit(SEED + 1)), F.lit(AMBASSADORS)).alias("seat")).agg(F.min("cls").alias("cls"), F.first("n").alias("n"))
    everywhere = F.transform(F.sequence(F.lit(0).cast("long"), parts - 1), lambda x: F.xxhash64("key", x))
    return dealt.select("key", "cls").union(sent.select(F.explode(everywhere).alias("key"), "cls")).distinct()


def nearby_links(classes: DataFrame, docs: DataFrame, shingle: int, min_similarity: float, key_limit: int, broadcast_rows: int) -> DataFrame:
    """First round: links (a, b) between classes that share the first minimum, through BK-trees of their fingerprints, each confirmed on the whole sets.

    It makes one class of most near copies, so that the second round has few
    groups left to look at.
    """
    keyed = classes.where("size > 0").select(F.col("minima")[0].alias("key"), "cls")
    shared = checkpointed(keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"))
    keyed = checkpointed(_ambassadors(checkpointed(keyed.join(shared, "key", "left_semi")), key_limit))
    sets = _sets(classes, docs, keyed.select("cls").distinct(), shingle, broadcast_rows)

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            ids, fps = run.column(1).to_pylist(), [fp & (1 << 64) - 1 for fp in run.column(2).to_pylist()]
            own = [np.frombuffer(x, "<u8") for x in run.column(3).to_pylist()]
            firsts = linked(fps, SIMILAR_RADIUS, lambda i, j, own=own: similar(own[i], own[j], min_similarity))
            pairs = [(ids[k], ids[first]) for k, first in enumerate(firsts) if k != first]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], names=["a", "b"])

    drawn = keyed.join(classes.select("cls", "fp"), "cls").join(sets, "cls").select("key", "cls", "fp", "hashes")
    return drawn.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(link, "a long, b long")


def met_before(minima: np.ndarray, i: int, others: np.ndarray, k: int) -> np.ndarray:
    """Whether row i shares a minimum before the k-th with each of the ``others``: such a pair meets there already."""
    return (minima[others, :k] == minima[i, :k]).any(axis=1)


def overlaps(sets: list[np.ndarray], columns: int = 4_096) -> np.ndarray:
    """How many hashes each two of the sets share."""
    n = len(sets)
    out, whole = np.zeros((n, n), np.float32), np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(x) for x in sets])
    _, place, times = np.unique(whole, return_inverse=True, return_counts=True)
    several = times[place] > 1
    # Only hashes that two sets hold can count; they are the columns of a matrix, some at a time.
    owner, place = owner[several], (np.cumsum(times > 1) - 1)[place[several]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    for at in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
        a, b = np.searchsorted(place, [at, at + columns])
        part = np.zeros((n, columns), np.float32)
        part[owner[a:b], place[a:b] - at] = 1
        out += part @ part.T
    out[np.arange(n), np.arange(n)] = [len(x) for x in sets]
    return out


def forest(alike: np.ndarray) -> list[tuple[int, int]]:
    """(row, first row of its component) of a symmetric relation, but for the first rows themselves."""
    left, out = np.ones(len(alike), bool), []
    for root in range(len(alike)):
        if not left[root]:
            continue
        left[root], edge = False, [root]
        while edge:
            found = np.flatnonzero(alike[edge].any(axis=0) & left)
            left[found] = False
            edge = found.tolist()
            out += [(row, root) for row in edge]
    return out


def _in_parts_of(keyed: DataFrame, limit: int, elements: int) -> DataFrame:
    """``keyed`` (key, k, cls, size), where groups of more than ``limit`` rows, or ``elements`` hashes, are cut by set size, each band with the next, and then dealt into pairs of chunks."""
    def sized(df: DataFrame) -> DataFrame:
        chunks = F.greatest(F.ceil(F.count("*") / limit), F.ceil(F.sum("size") / elements))
        return checkpointed(df.groupBy("key").agg(chunks.alias("chunks")).where("chunks > 1"))

    large = sized(keyed)
    if large.isEmpty():
        return keyed
    # Sets of similar sizes: 1.01 leaves room for rounding.
    band = F.floor(F.log("size") / F.col("ratio"))
    banded = keyed.join(large, "key", "left").withColumn("key", F.explode(F.when(F.col("chunks").isNull(), F.array("key")).otherwise(F.array(F.xxhash64("key", band), F.xxhash64("key", band + 1))))).drop("chunks")
    banded = checkpointed(banded)
    large = sized(banded)
    if large.isEmpty():
        return banded
    joined = banded.join(large, "key", "left").withColumn("chunk", F.pmod(F.xxhash64("cls", F.lit(SEED)), F.col("chunks")))
    others = F.filter(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1), lambda x: x != F.col("chunk"))
    pairs = F.transform(others, lambda x: F.xxhash64("key", F.least(x, F.col("chunk")), F.greatest(x, F.col("chunk"))))
    return joined.withColumn("key", F.explode(F.when(F.col("chunks").isNull(), F.array("key")).otherwise(pairs))).drop("chunks", "chunk")


def remaining_links(classes: DataFrame, roots: DataFrame, docs: DataFrame, shingle: int, min_similarity: float, key_limit: int, broadcast_rows: int) -> DataFrame:
    """Second round: links (a, b) that connect all similar classes whose ``roots`` differ and that share any minimum.

    Groups of a minimum that are one component already are left out. Bounds on
    sizes and sketches tell which classes can be similar to one of another
    component at all; only the whole sets of these are sent, and compared in
    their groups, each pair under the first minimum that it shares. A group
    gives a row for each class and link of a spanning forest, never its pairs.

    Groups of more than ``key_limit`` classes are cut by set size and dealt into
    pairs of chunks: a sketch is sent n / key_limit times where n classes of one
    size share a minimum and are not one component.
    """
    members = classes.where("size > 0").select("cls", "size", "sketch", "minima").join(roots.select(F.col("node").alias("cls"), F.col("root").alias("linked")), "cls", "left")
    members = checkpointed(members.withColumn("root", F.coalesce("linked", "cls")).drop("linked"))
    ratio = F.lit(math.log(1.01 / min_similarity)).alias("ratio")
    keyed = members.select("cls", "root", "size", ratio, F.posexplode("minima").alias("k", "minimum")).withColumn("key", F.xxhash64("k", "minimum"))
    mixed = checkpointed(keyed.groupBy("key").agg(F.min("root").alias("least"), F.max("root").alias("most")).where("least <> most").select("key"))
    keyed = _in_parts_of(checkpointed(keyed.select("key", "k", "cls", "size", "ratio").join(mixed, "key", "left_semi")), key_limit, 1 << 40)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            k, ids, own, sizes = run.column(1)[0].as_py(), *(run.column(c).to_numpy() for c in (2, 3, 4))
            if (own == own[0]).all():
                continue
            sketches = [np.frombuffer(x, np.uint8) for x in run.column(5).to_pylist()]
            minima = np.asarray(run.column(6).combine_chunks().flatten()).reshape(-1, MINIMA)
            buckets, alike = np.array([len(x) for x in sketches]), np.zeros(len(ids), bool)
            ends = np.searchsorted(sizes, sizes / min_similarity + 1e-6, "right")  # rows, and so their buckets, are in order of size
            level, at = None, 0
            for i, end in enumerate(ends.tolist()):
                if buckets[i] != level:
                    # All that rows of this many buckets can be compared with, in as many buckets.
                    level, at = buckets[i], i
                    last = ends[np.searchsorted(buckets, level, "right") - 1]
                    counts = np.concatenate([_folded(np.stack(list(same)), level) for _, same in groupby(sketches[i:last], len)])
                others = i + 1 + np.flatnonzero(own[i + 1 : end] != own[i])
                if not len(others):
                    continue
                apart = np.abs(counts[others - at] - counts[i - at]).sum(axis=1, dtype=np.int64)
                both = int(sizes[i]) + sizes[others]
                near = others[apart <= both * ((1 - min_similarity) / (1 + min_similarity)) + 1e-6]
                near = near[~met_before(minima, i, near, k)]
                if len(near):
                    alike[i] = alike[near] = True
            if alike.any():
                n = int(alike.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(n, run.column(0)[0].as_py())), pa.array(np.full(n, k, np.int32)), pa.array(ids[alike])], names=["key", "k", "cls"])

    described = members.select("cls", "root", "size", "sketch", "minima")
    drawn = keyed.select("key", "k", "cls").join(described, "cls").select("key", "k", "cls", "root", "size", "sketch", "minima")
    near = checkpointed(drawn.repartition("key").sortWithinPartitions("key", "size").mapInArrow(meet, "key long, k int, cls long").distinct())
    if near.isEmpty():
        return near.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    near = _in_parts_of(near.join(members.select("cls", "size", ratio), "cls").select("key", "k", "cls", "size", "ratio"), key_limit, GROUP_HASHES)
    sets = checkpointed(_sets(classes, docs, near.select("cls").distinct(), shingle, broadcast_rows))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in runs(batches):
            k, ids, own = run.column(1)[0].as_py(), run.column(2).to_numpy(), run.column(3).to_numpy()
            if (own == own[0]).all():
                continue
            minima = np.asarray(run.column(4).combine_chunks().flatten()).reshape(-1, MINIMA)
            both = overlaps([np.frombuffer(x, "<u8") for x in run.column(5).to_pylist()])
            sizes = np.diagonal(both)
            alike = (both >= min_similarity * (sizes[:, None] + sizes[None] - both) - 1e-4) & (own[:, None] != own[None])
            for i in np.flatnonzero(alike.any(axis=1)).tolist():
                others = np.flatnonzero(alike[i])
                alike[i, others[met_before(minima, i, others, k)]] = False
            links = forest(alike)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(ids[list(x)]) for x in zip(*links, strict=True)], names=["a", "b"])

    drawn = near.select("key", "k", "cls").join(members.select("cls", "root", "minima"), "cls").join(sets, "cls").select("key", "k", "cls", "root", "minima", "hashes")
    return checkpointed(drawn.repartition("key").sortWithinPartitions("key", "cls").mapInArrow(confirm, "a long, b long").distinct())


def simhash_dedup(docs: DataFrame, shingle: int = 5, min_similarity: float = 0.8, id_col: str = "doc_id", text_col: str = "text", key_limit: int = KEY_LIMIT, broadcast_rows: int = 1_000_000) -> DataFrame:
    """``docs`` with one row of each near-duplicate class, that of the smallest id (null ids last).

    Texts are alike if the Jaccard similarity of their word-shingle sets is
    ``min_similarity`` or more; classes are the components. Texts without
    words are copies of each other. Sets meet where they share one of
    ``MINIMA`` minima of hashed shingles: first those that lie near one another
    in BK-trees of SimHash fingerprints (over the set, so repeats do not
    matter), then all others that bounds do not exclude. Every link is
    confirmed by the exact similarity of whole sets. All columns are kept as
    they are, whatever their names.
    """
    rows = whole_rows(docs, id_col, text_col)
    described = checkpointed(_described(rows, shingle))
    classes, how = checkpointed(_classes(described)), (rows, shingle, min_similarity, key_limit, broadcast_rows)
    links = checkpointed(nearby_links(classes, *how))
    roots = checkpointed(connected_components(links))
    more = remaining_links(classes, roots, *how)
    if not more.isEmpty():
        roots = connected_components(links.union(more))
    of_class = classes.select("cls", "first").join(roots.withColumnRenamed("node", "cls"), "cls", "left")
    kept = of_class.groupBy(F.coalesce("root", "cls").alias("root")).agg(F.min("first").alias("first")).select(F.col("first.rid").alias("rid"))
    times = described.groupBy("rid").agg(F.count("*").alias("n"))
    kept = checkpointed(kept.join(times, "rid"))
    dropped = checkpointed(described.select("rid").join(kept, "rid", "left_anti").distinct())
    left = _of_rows(rows.select("doc", "rid"), dropped, "left_anti", broadcast_rows)
    repeated = kept.where("n > 1").select("rid")
    if repeated.isEmpty():
        return left.select("doc.*")
    once = _of_rows(left, repeated, "left_anti", broadcast_rows)
    return once.unionByName(_of_rows(left, repeated, "left_semi", broadcast_rows).dropDuplicates(["rid"])).select("doc.*")
