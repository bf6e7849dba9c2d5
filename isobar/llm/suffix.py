"""Removal of repeated byte strings by a depth-limited radix sort of suffixes.

A byte goes if a string of ``threshold`` bytes covers it that also starts
anywhere else. Suffixes are ordered through ``threshold`` bytes only, and only
where an order can matter:

1. Of every window of ``threshold`` bytes one gram of ``GRAM`` bytes is marked,
   that with the least hash (the last of equals). Equal windows mark the same
   gram at the same place, so a repeated window has a repeated mark; marks are
   one in about 85 bytes.
2. First digit: marks are grouped by their gram's hash. Partial sums count a
   hot gram before the shuffle; grams that occur once leave the sort here.
3. Second digit: the whole surroundings (all windows over the mark). Where all
   marks of a gram, or several, agree in them, they are repeated in full.
4. Only one mark of each remaining surroundings goes on. Its bytes to the left
   and to the right are sorted by most-significant-digit passes, a byte a pass;
   groups of one leave. The groups that are equal in l bytes to the left and in
   the rest of the threshold to the right are exactly the repeated windows.

Matches never cross texts. A null or empty text, or one shorter than the
threshold, keeps all its bytes. Rows that repeat each other in full repeat
each other's bytes; rows that repeat an id with another text are texts of their
own; null ids are ids. An empty table gives an empty result. Texts are taken
whole at any length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isobar.llm.common import checkpointed, in_parts, map_texts, remove, scratch_path, whole_rows, written
from isobar.llm.simhash import runs

GRAM = 32
#: Rows sorted at once; a run of one gram stays together.
SORT_ROWS = 20_000
#: Different surroundings of one gram that one task sorts; beyond that they are dealt out by what equal windows share, again and again.
SPLIT_ROWS = 100_000
#: Places and spans are broadcast up to this many bytes, by count; beyond it the texts are shuffled to them.
BROADCAST_BYTES = 64 << 20
#: What a row of them takes in a broadcast table, beside its places.
ROW_BYTES = 160

_BYTES = np.random.default_rng(17).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram at each place, from hashes of its two halves."""
    out, width, done = _BYTES[data], 1, None
    done_width, left = 0, gram
    while left:
        if left & 1:
            if done is None:
                done = out
            else:
                n = len(data) - done_width - width + 1
                done = done[:n] * np.uint64(pow(_STEP, width, 1 << 64)) + out[done_width : done_width + n]
            done_width += width
        left >>= 1
        if left:
            n = len(data) - 2 * width + 1
            out = out[:n] * np.uint64(pow(_STEP, width, 1 << 64)) + out[width : width + n]
            width *= 2
    mixed = (done ^ (done >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return mixed ^ (mixed >> np.uint64(29))


def marks(data: np.ndarray, threshold: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the marked grams: in each window the least hash, the last of equals."""
    if len(data) < threshold:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    hashes = gram_hashes(data, gram)
    span = threshold - gram + 1
    least, width = hashes, 1
    while width * 2 <= span:
        least = np.minimum(least[: len(least) - width], least[width:])
        width *= 2
    if width < span:
        n = len(hashes) - span + 1
        least = np.minimum(least[:n], least[span - width : span - width + n])
    # A place is marked if it is the last with the least hash of some window that holds it.
    at = np.flatnonzero(hashes == _largest_around(least, span, len(hashes)))
    if len(at) > 1:
        same = np.flatnonzero((hashes[at[1:]] == hashes[at[:-1]]) & (at[1:] - at[:-1] < span))
        if len(same):  # of equal hashes near one another, an earlier one counts only for windows that end before the next
            starts = np.zeros(len(at), bool)
            starts[same] = True
            keep = np.ones(len(at), bool)
            for k in np.flatnonzero(starts):
                first, last = max(0, at[k] - span + 1), min(at[k + 1] - span, len(least) - 1)
                keep[k] = last >= first and bool((least[first : last + 1] == hashes[at[k]]).any())
            at = at[keep]
    return at, hashes[at]


def _largest_around(least: np.ndarray, span: int, n: int) -> np.ndarray:
    """For each of n places the largest of the windows' minima among the windows that hold it."""
    padded = np.concatenate([np.zeros(span - 1, np.uint64), least, np.zeros(n - len(least), np.uint64)])
    width = 1
    while width * 2 <= span:
        padded = np.maximum(padded[: len(padded) - width], padded[width:])
        width *= 2
    return np.maximum(padded[:n], padded[span - width : span - width + n])


MARK = T.StructType([T.StructField("gram", T.LongType()), T.StructField("around", T.LongType()), T.StructField("at", T.IntegerType())])


def _marked(docs: DataFrame, threshold: int) -> DataFrame:
    """rid and marks (gram, around (hash of all windows over the mark) and at) of every row that has any."""
    reach = threshold - GRAM

    def start():
        def mark(texts: list[str]) -> list:
            grams, arounds, places, ends = [], [], [], [0]
            for text in texts:
                data = text.encode()
                at, hashes = marks(np.frombuffer(data, np.uint8), threshold)
                starts = np.maximum(at - reach, 0)
                grams.append(hashes.view(np.int64))
                places.append(at.astype(np.int32))
                arounds += [xxhash.xxh3_64_intdigest(data[s : a + threshold], a - s) for a, s in zip(at.tolist(), starts.tolist(), strict=True)]
                ends.append(ends[-1] + len(at))
            columns = [np.concatenate(grams) if grams else np.empty(0, np.int64), np.array(arounds, dtype=np.uint64).view(np.int64), np.concatenate(places) if places else np.empty(0, np.int32)]
            found = pa.StructArray.from_arrays([pa.array(c) for c in columns], MARK.names)
            return [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), found)]

        return mark

    return map_texts(docs, ["rid"], F.col("text"), start, [T.StructField("marks", T.ArrayType(MARK))]).where(F.size("marks") > 0)


def _passes(group: np.ndarray, digits: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Most-significant-digit passes: [d, row] is the row's group by its first d digits, -1 once it is alone."""
    n, depth = digits.shape
    out = np.full((depth + 1, n), -1, np.int32)
    rows, own = np.arange(n), group.astype(np.int64)
    out[0] = group
    for d in range(depth):
        more = lengths[rows] > d
        rows, own = rows[more], own[more]
        if not len(rows):
            break
        _, own, counts = np.unique(own * 256 + digits[rows, d], return_inverse=True, return_counts=True)
        several = counts[own] > 1
        rows, own = rows[several], own[several]
        out[d + 1, rows] = own
    return out


def repeated_windows(group: np.ndarray, left: list[bytes], right: list[bytes], reach: int) -> list[list[int]]:
    """For each row, how far to the left the windows start that another row of its group has too."""
    def matrix(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(p.ljust(reach, b"\0") for p in parts), np.uint8).reshape(len(parts), reach), np.array([len(p) for p in parts])

    lefts = _passes(group, *matrix([p[::-1] for p in left]))
    rights = _passes(group, *matrix(right))
    out: list[list[int]] = [[] for _ in left]
    for back in range(reach + 1):
        rows = np.flatnonzero((lefts[back] >= 0) & (rights[reach - back] >= 0))
        if len(rows) > 1:
            _, own, counts = np.unique(lefts[back, rows].astype(np.int64) * (len(left) + group.max() + 1) + rights[reach - back, rows], return_inverse=True, return_counts=True)
            for row in rows[counts[own] > 1].tolist():
                out[row].append(back)
    return out


def _stretches(reach: int) -> list[tuple[int, int]]:
    """0..reach, cut into stretches [low, high) that are narrow at both ends."""
    steps = [p for p in (*range(9), 16, 32, 64, 128, 256) if p <= (reach + 1) // 2]
    edges = sorted({*steps, *(reach + 1 - p for p in steps)})
    return list(zip(edges, edges[1:], strict=False))


def _shared(reach: int) -> Column:
    """What two marks' surroundings share if a window that starts low..high-1 bytes before the mark is equal: low bytes before it, and those behind it; null where a text's end is nearer."""
    low, behind = F.col("low"), F.lit(reach + 1) - F.col("high")
    own = F.substring("before", F.length("before") - low + 1, low), F.substring("after", F.lit(1), behind)
    key = F.unhex(F.md5(F.concat(F.concat_ws(",", F.col("gram").cast("string"), low.cast("string"), F.col("high").cast("string"), F.lit("")).cast("binary"), *own)))
    return F.when((F.length("before") >= low) & (F.length("after") >= behind), key)


def _split(cuts: DataFrame, grams: DataFrame, reach: int, threshold: int) -> tuple[DataFrame, DataFrame]:
    """The cuts of the few hot ``grams`` under keys of what equal windows share, and the spans of windows that a key gives whole.

    A hot gram's group falls apart by the bytes beside the mark, for stretches
    of windows; where one is still larger than ``SPLIT_ROWS`` its stretch is cut
    in half. Where the key is the whole window, counting is enough, and partial
    sums take a hot window before the shuffle.
    """
    hot = checkpointed(cuts.join(grams, "gram", "left_semi").dropDuplicates(["gram", "rid", "at"]))

    def stretch(edges: list[tuple[Column, Column]]) -> Column:
        return F.explode(F.array(*[F.struct(low.cast("int").alias("low"), high.cast("int").alias("high")) for low, high in edges]))

    def keyed(rows: DataFrame) -> DataFrame:
        return rows.select(*hot.columns, "stretch.*").withColumn("key", _shared(reach)).where("key is not null")

    single = F.col("high") - F.col("low") == 1
    level = keyed(hot.withColumn("stretch", stretch([(F.lit(low), F.lit(high)) for low, high in _stretches(reach)])))
    windows, dealt = level.where(single).select("rid", "at", "key", "low"), hot.limit(0)
    while True:
        wide = level.where(~single)
        large = checkpointed(wide.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT_ROWS).select("key"))
        dealt = dealt.unionByName(wide.join(F.broadcast(large), "key", "left_anti").withColumn("gram", F.xxhash64("key")).select(hot.columns))
        if large.isEmpty():
            break
        middle = F.floor((F.col("low") + F.col("high")) / 2)
        halves = wide.join(F.broadcast(large), "key", "left_semi").withColumn("stretch", stretch([(F.col("low"), middle), (middle, F.col("high"))]))
        level = keyed(halves.select(*hot.columns, "stretch"))
        windows = windows.unionByName(level.where(single).select("rid", "at", "key", "low"))
    twice = checkpointed(windows.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    spans = windows.join(twice, "key").select("rid", (F.col("at") - F.col("low")).alias("start"), (F.col("at") - F.col("low") + threshold).alias("end"))
    return cuts.join(grams, "gram", "left_anti").unionByName(dealt), spans


def _beside(texts: DataFrame, found: DataFrame, n_bytes: int, how: str) -> DataFrame:
    """``texts`` with what was found for them by rid; broadcast only if counted to be small, else both are shuffled."""
    return texts.join(F.broadcast(found) if n_bytes <= BROADCAST_BYTES else found.hint("merge"), "rid", how)


def repeated_spans(docs: DataFrame, threshold: int = 200) -> DataFrame:
    """(rid, starts, ends): the byte spans of ``docs`` (rid and text, no nulls) that repeated windows cover.

    Spans are merged and in order; they can begin before 0 and end behind the
    text, where all windows up to its end are repeated.
    """
    reach = threshold - GRAM
    # Written once, as it is read twice: a text is hashed once.
    at = scratch_path(docs.sparkSession, "marks")
    written_marks = written(_marked(docs, threshold), at)
    marked = written_marks.select("rid", F.inline("marks"))
    grams = marked.groupBy("gram").agg(F.count("*").alias("n"), F.min("around").alias("least"), F.max("around").alias("most")).where("n > 1")
    grams = checkpointed(grams.select("gram", (F.col("least") != F.col("most")).alias("mixed")))
    repeated = checkpointed(marked.join(grams, "gram"))
    mixed = repeated.where("mixed")
    # Written first, so that both sides of the join are plain exchanges and a class with most of the marks is split.
    classes = checkpointed(mixed.groupBy("gram", "around").agg(F.count("*").alias("n"), F.min(F.struct("rid", "at")).alias("one")))
    counted = checkpointed(mixed.join(classes, ["gram", "around"]).select("gram", "rid", "at", (F.col("n") > 1).alias("several"), (F.struct("rid", "at") == F.col("one")).alias("first")))
    full = repeated.where("not mixed").select("rid", "at").union(counted.where("several").select("rid", "at"))
    full = full.select("rid", (F.col("at") - reach).alias("start"), (F.col("at") + threshold).alias("end"))

    # Rows that repeat each other in full share a rid and its places, which are taken once.
    firsts = checkpointed(counted.where("first").select("gram", "rid", "at").distinct())
    wanted = firsts.groupBy("rid").agg(F.collect_list(F.struct("gram", "at")).alias("w"))
    wanted = checkpointed(wanted.select("rid", F.transform("w", lambda w: w["gram"]).alias("grams"), F.transform("w", lambda w: w["at"]).alias("places")))
    size = wanted.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("grams")), F.lit(0)).alias("marks")).first()
    texts = _beside(docs.select("rid", "text"), wanted, ROW_BYTES * size["rows"] + 16 * size["marks"], "inner")
    several = checkpointed(written_marks.select("rid").join(wanted, "rid", "left_semi").groupBy("rid").agg(F.count("*").alias("n")).where("n > 1").select("rid"))
    if n_several := several.count():
        once = _beside(texts, several, ROW_BYTES * n_several, "left_anti")
        texts = once.unionByName(_beside(texts, several, ROW_BYTES * n_several, "left_semi").dropDuplicates(["rid"]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            rows: list[tuple] = []
            for rid, text, own, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                rows += [(g, rid, a, data[max(0, a - reach) : a], data[a + GRAM : a + threshold]) for g, a in zip(own, places, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(column, f.type) for column, f in zip(zip(*rows, strict=True) if rows else [()] * 5, around, strict=True)], schema=around)

    around = pa.schema([("gram", pa.int64()), ("rid", pa.binary()), ("at", pa.int32()), ("before", pa.binary()), ("after", pa.binary())])
    cuts = texts.select("rid", "text", "grams", "places").mapInArrow(cut, "gram long, rid binary, at int, before binary, after binary")
    large = checkpointed(firsts.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT_ROWS).select("gram"))
    whole = None
    if not large.isEmpty():
        cuts, whole = _split(cuts, large, reach, threshold)
    cuts = cuts.repartition("gram").sortWithinPartitions("gram", "rid", "at")
    found = pa.schema([("rid", pa.binary()), ("start", pa.int32()), ("end", pa.int32())])

    def radix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        for run in runs(batches):
            held.append(run)
            if sum(map(len, held)) >= SORT_ROWS:
                yield sort(pa.concat_tables(held))
                held = []
        if held:
            yield sort(pa.concat_tables(held))

    def sort(table: pa.Table) -> pa.RecordBatch:
        gram, at, rid = table.column(0).to_numpy(), table.column(2).to_numpy(), np.array(table.column(1).to_pylist(), object)
        first = np.ones(len(gram), bool)
        first[1:] = (gram[1:] != gram[:-1]) | (rid[1:] != rid[:-1]) | (at[1:] != at[:-1])
        table, gram, rid, at = table.filter(pa.array(first)), gram[first], rid[first], at[first]
        group = np.concatenate([[0], np.cumsum(gram[1:] != gram[:-1])])
        backs = repeated_windows(group, table.column(3).to_pylist(), table.column(4).to_pylist(), reach)
        rows = []
        for r, a, own in zip(rid.tolist(), at.tolist(), backs, strict=True):
            # Windows that start side by side cover one span.
            for k, back in enumerate(own):
                if k and back == own[k - 1] + 1:
                    rows[-1] = (r, a - back, rows[-1][2])
                else:
                    rows.append((r, a - back, a - back + threshold))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * 3, found, strict=True)], schema=found)

    spans = full.union(cuts.mapInArrow(radix, "rid binary, start int, end int"))
    if whole is not None:
        spans = spans.union(whole)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unions = [merged([(s["start"], s["end"]) for s in own]) for own in batch.column(1).to_pylist()]
            sides = [pa.array([[span[k] for span in union] for union in unions], pa.list_(pa.int32())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *sides], names=["rid", "starts", "ends"])

    out = checkpointed(spans.groupBy("rid").agg(F.collect_set(F.struct("start", "end")).alias("spans")).mapInArrow(merge, "rid binary, starts array<int>, ends array<int>"))
    remove(docs.sparkSession, at)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def without(data: bytes, spans: list[tuple[int, int]], whole_characters: bool = False) -> bytes:
    """``data`` without the spans; with ``whole_characters`` a character that a span holds in part stays."""
    kept, at = [], 0
    for start, end in spans:
        if whole_characters:
            while start < end and data[start] & 0xC0 == 0x80:
                start += 1
            while end > start and end < len(data) and data[end] & 0xC0 == 0x80:
                end -= 1
        kept.append(data[at:start])
        at = end
    return b"".join([*kept, data[at:]])


def remove_repeats(docs: DataFrame, threshold: int = 200, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), outputs: tuple[str, ...] = ("spans", "kept")) -> DataFrame:
    """``keep``, n_bytes, n_removed, n_spans and the named outputs of every row.

    Outputs: spans (array<struct<start, end>>, maximal removed runs in bytes),
    kept (the remaining text, where a character cut in part stays), kept_sha256
    (lowercase hex digest of exactly the remaining bytes). ``keep`` must not
    name a column as one of these.
    """
    new = ("n_bytes", "n_removed", "n_spans", *outputs)
    found = _cut(docs, threshold, id_col, text_col, keep, outputs)
    return found.select(*[F.col(f"doc.`{name}`").alias(name) for name in keep], *new)


def without_repeats(docs: DataFrame, threshold: int = 200, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with what is left of each text, and its length in characters in ``count_col``; all other columns as they are, whatever their names."""
    new = {text_col: F.col("kept")} | ({count_col: F.length("kept").cast(docs.schema[count_col].dataType)} if count_col in docs.columns else {})
    found = _cut(docs, threshold, id_col, text_col, [name for name in docs.columns if name not in new], ("kept",))
    return found.select(*[(new[name] if name in new else F.col(f"doc.`{name}`")).alias(name) for name in docs.columns])


def _cut(docs: DataFrame, threshold: int, id_col: str, text_col: str, carry: Iterable[str], outputs: tuple[str, ...]) -> DataFrame:
    """doc (the columns ``carry``), n_bytes, n_removed, n_spans and the named outputs of every row."""
    whole = whole_rows(docs, id_col, text_col, carry)
    spans = repeated_spans(whole.select("rid", "text"), threshold)
    n_bytes = spans.agg(F.sum(8 * F.size("starts") + ROW_BYTES)).first()[0] or 0
    rows = _beside(whole.select("doc", "rid", "text"), spans, n_bytes, "left").select("doc", "text", "starts", "ends")
    kinds = {"spans": T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])), "kept": T.StringType(), "kept_sha256": T.StringType()}
    make = {
        "spans": lambda data, runs: [{"start": s, "end": e} for s, e in runs],
        "kept": lambda data, runs: without(data, runs, whole_characters=True).decode(),
        "kept_sha256": lambda data, runs: hashlib.sha256(without(data, runs)).hexdigest(),
    }
    counts = [T.StructField(name, T.LongType()) for name in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([rows.schema["doc"], *counts, *(T.StructField(name, kinds[name]) for name in outputs)])
    arrow = to_arrow_schema(schema)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_parts(batches):
            columns: list[list] = [[] for _ in range(3 + len(outputs))]
            for text, starts, ends in zip(*(batch.column(1 + k).to_pylist() for k in range(3)), strict=True):
                data = text.encode()
                spans = [(max(s, 0), min(e, len(data))) for s, e in zip(starts or (), ends or (), strict=True)]
                values = [len(data), sum(e - s for s, e in spans), len(spans), *(make[o](data, spans) for o in outputs)]
                for column, value in zip(columns, values, strict=True):
                    column.append(value)
            new = [pa.array(c, f.type) for c, f in zip(columns, list(arrow)[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *new], names=arrow.names)

    return rows.mapInArrow(cut, schema)
