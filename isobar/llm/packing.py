"""Packing into windows by minimum bin slack.

A document of more than a window's ids gives full windows and a rest; the
rests are packed. How many rests have each length is all that the search
needs: it sees ``capacity`` counts at most, whatever the size of the corpus.
For the longest length left it looks for the multiset of remaining lengths
that fills the window closest to capacity, by a bitset subset-sum program over
the lengths (each in powers of two up to its count), reads the counts of the
best sum back, and uses that filling as often as the counts allow. A filling
ends at least one length, so there are at most ``capacity`` or so fillings.

Documents then take their places by their rank among the rests of their
length. Ranks come from salted windows (length, hash of the document) and a
table of the salts' counts, so a length that a third of all documents have is
ranked by many tasks. There are as many salts as keep a window at about
``SALT_ROWS`` rows at most, whatever the size of the corpus; their counts stay
on the cluster, and only a row a length comes to the driver.

A null text is an empty document, which still has its end id. Rows that repeat
an id are packed one by one; a null id is an id like any other. An empty table
gives an empty result. Other columns are ignored; texts are taken whole.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.bpe import encoder
from isobar.llm.common import checkpointed, map_texts, text_or_empty

SALTS, SALT_ROWS = 64, 100_000


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths with the longest one and the least slack: length -> times in one window."""
    longest = max(counts)
    room = capacity - longest
    mask = (1 << (room + 1)) - 1
    items = []
    for length in sorted(counts, reverse=True):
        left = min(counts[length] - (length == longest), room // length)
        step = 1
        while left > 0:
            take = min(step, left)
            items.append((length, take))
            left -= take
            step *= 2
    reach, history = 1, []
    for length, take in items:
        history.append(reach)
        reach |= reach << (length * take) & mask
        if reach >> room & 1:
            break
    best, out = reach.bit_length() - 1, {longest: 1}
    for k in range(len(history) - 1, -1, -1):
        if history[k] >> best & 1:
            continue
        length, take = items[k]
        out[length] = out.get(length, 0) + take
        best -= length * take
    return out


def plan(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Fillings and how many windows use each; together they use up ``counts``."""
    left, out = {k: n for k, n in counts.items() if n}, []
    while left:
        one = fill(left, capacity)
        times = min(left[k] // n for k, n in one.items())
        out.append((one, times))
        for k, n in one.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
    return out


def _places(fillings: list[tuple[dict[int, int], int]]) -> dict[int, list[tuple[int, int, int, int]]]:
    """length -> (first rank, times in a window, first window, offset in the window), in rank order."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    window = 0
    for one, times in fillings:
        offset = 0
        for length in sorted(one, reverse=True):
            out.setdefault(length, []).append((used.get(length, 0), one[length], window, offset))
            used[length] = used.get(length, 0) + one[length] * times
            offset += one[length] * length
        window += times
    return out


def _measured(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, id_col: str, text_col: str) -> DataFrame:
    """A row for each document: its length in ids and the crc32 of each of its pieces, whole windows first."""

    def start():
        encode, end, width = encoder(tokenizer), end_id.to_bytes(4, "little"), 4 * capacity

        def measure(texts: list[str]) -> list:
            data = [encode(text) + end for text in texts]
            return [[len(x) // 4 for x in data], [[zlib.crc32(x[i : i + width]) for i in range(0, len(x), width)] for x in data]]

        return measure

    text = text_or_empty(text_col)
    rows = docs.select(F.col(id_col).alias("__id"), F.xxhash64(text).alias("__hash"), text.alias("__whole"))
    return map_texts(rows, ["__id", "__hash"], F.col("__whole"), start, [T.StructField("doc_tokens", T.LongType()), T.StructField("crcs", T.ArrayType(T.LongType()))])


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each piece: id, start, length, ids_crc32, doc_tokens, sequence_id and offset."""
    spark = docs.sparkSession
    measured = checkpointed(_measured(docs, tokenizer, end_id, capacity, id_col, text_col).withColumns({"full": F.floor(F.col("doc_tokens") / capacity), "rest": F.col("doc_tokens") % capacity}))
    salts = max(SALTS, -(-measured.count() // SALT_ROWS))
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("__id", "__hash"), F.lit(salts)))
    by_salt = checkpointed(salted.groupBy("rest", "salt").agg(F.count("*").alias("n"), F.sum("full").alias("n_full")))
    # At most ``capacity`` rows.
    lengths = [tuple(r) for r in by_salt.groupBy("rest").agg(F.sum("n"), F.sum("n_full")).orderBy("rest").collect()]
    fillings = plan({rest: n for rest, n, _ in lengths if rest}, capacity)
    places, windows, fulls = _places(fillings), sum(times for _, times in fillings), []
    for rest, _, n_full in lengths:
        fulls.append((rest, windows, places.get(rest)))
        windows += n_full
    by_length = spark.createDataFrame(fulls, "rest long, first_full long, places array<struct<rank:long,times:long,window:long,offset:long>>")
    before = Window.partitionBy("rest").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    base = by_salt.select("rest", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("rank_base"), F.coalesce(F.sum("n_full").over(before), F.lit(0)).alias("full_base"))

    own = Window.partitionBy("rest", "salt").orderBy("__id", "__hash")
    ranked = (
        salted.withColumns({"rank": F.row_number().over(own) - 1, "fulls": F.coalesce(F.sum("full").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))})
        .join(base, ["rest", "salt"])
        .join(F.broadcast(by_length), "rest")
        .withColumns({"rank": F.col("rank") + F.col("rank_base"), "fulls": F.col("fulls") + F.col("full_base") + F.col("first_full")})
        .withColumn("place", F.try_element_at(F.filter("places", lambda p: p["rank"] <= F.col("rank")), F.lit(-1)))
    )
    k = F.col("k").cast("long")
    is_full = k < F.col("full")
    used = F.col("rank") - F.col("place.rank")
    return ranked.select("*", F.posexplode("crcs").alias("k", "ids_crc32")).select(
        F.col("__id").alias(id_col),
        (k * capacity).alias("start"),
        F.when(is_full, F.lit(capacity)).otherwise(F.col("rest")).cast("long").alias("length"),
        "ids_crc32",
        "doc_tokens",
        F.when(is_full, F.col("fulls") + k).otherwise(F.col("place.window") + F.floor(used / F.col("place.times"))).cast("long").alias("sequence_id"),
        F.when(is_full, F.lit(0)).otherwise(F.col("place.offset") + used % F.col("place.times") * F.col("rest")).cast("long").alias("offset"),
    )
