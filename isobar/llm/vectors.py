"""What both vector searches share: whole vectors, copies as one, bounded groups, and the best of what is found.

Copies are searched for once: a distinct vector stands for all rows that hold
it, with the k + 1 smallest of their ids, which are all that a list of k can
show once the query's own is left out. So a group of copies, however large, is
one candidate and one query.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from isobar.llm.common import checkpointed


def whole_vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector array<double>, dim) of the rows whose vector is there and has only finite components."""
    vector = F.col(vector_col).cast("array<double>")
    huge = F.lit(float("inf"))
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != huge))
    return df.select(F.col(id_col).cast("long").alias("id"), vector.alias("vector")).where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("dim", F.size("vector")).where("dim > 0")


def distinct_vectors(vectors: DataFrame, is_query: str, k: int) -> tuple[DataFrame, DataFrame]:
    """``vectors`` without copies, and the queries.

    The first: vkey (long), vector, dim, ids (the k + 1 smallest of its rows,
    ascending) and asked (whether a query holds it). The second: id and vkey of
    every row for which ``is_query`` holds.
    """
    first = Window.partitionBy("vector").orderBy("id")
    few = vectors.dropDuplicates(["vector", "id"]).withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    ids = few.groupBy("vector").agg(F.first("dim").alias("dim"), F.array_sort(F.collect_list("id")).alias("ids"))
    asked = vectors.where(is_query).select("id", "vector").distinct()
    held = asked.select("vector").distinct().withColumn("asked", F.lit(True))
    found = ids.join(held, "vector", "left").select(F.monotonically_increasing_id().alias("vkey"), "vector", "dim", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    found = checkpointed(found)
    return found, asked.join(found.where("asked").select("vector", "vkey"), "vector").select("id", "vkey")


def bounded_sample(df: DataFrame, rows: int, n: int, key: str = "vkey") -> DataFrame:
    """At most ``n`` of about ``rows`` rows, by a hash of the key."""
    share = min(1.0, 1.2 * n / max(rows, 1)) if rows > n else 1.0
    return df.where(F.shiftrightunsigned(F.xxhash64(key, F.lit(11)), 1) <= int(share * (2**63 - 1024))).orderBy(F.xxhash64(key), key).limit(n)


def stacked(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """A matrix of a column of equally long vectors."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), dtype=float).reshape(-1, dim)


def in_groups(index: DataFrame, queries: DataFrame, keys: Sequence[str], index_rows: int, query_rows: int, counted: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with a column ``chunk``, so that groups of ``keys`` and chunk are bounded and every pair of a group's rows still meets once.

    Groups with more rows than ``index_rows`` or ``query_rows`` on either side
    are dealt into that many chunks; a row goes to all chunks of the other side.
    ``counted`` has partial counts (keys, rows) of both sides, where counting
    them again would deal them out twice.
    """
    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*keys).agg(F.sum("rows").alias(name))

    ones = counted or (index.withColumn("rows", F.lit(1)), queries.withColumn("rows", F.lit(1)))
    sizes = checkpointed(counts(ones[0], "n").join(counts(ones[1], "q"), list(keys)).select(*keys, F.ceil(F.col("n") / index_rows).alias("n"), F.ceil(F.col("q") / query_rows).alias("q")))
    if sizes.where("n > 1 OR q > 1").isEmpty():
        return index.withColumn("chunk", F.lit(0).cast("long")), queries.withColumn("chunk", F.lit(0).cast("long"))

    def each(n: Column) -> Column:
        return F.sequence(F.lit(0).cast("long"), n - 1)

    own = F.pmod(F.xxhash64("vkey", F.lit(5)), F.col("n")), F.pmod(F.xxhash64("vkey", F.lit(6)), F.col("q"))
    left = index.join(sizes, list(keys)).withColumn("chunk", F.explode(F.transform(each(F.col("q")), lambda b: own[0] * F.col("q") + b)))
    right = queries.join(sizes, list(keys)).withColumn("chunk", F.explode(F.transform(each(F.col("n")), lambda a: a * F.col("q") + own[1])))
    return left.drop("n", "q"), right.drop("n", "q")


def spread(n: int, rows: int, most: int = 1 << 16) -> int:
    """Bits that deal ``n`` rows into groups of about ``rows``."""
    return max(0, min(int(math.log2(most)), math.ceil(math.log2(max(1, n) / rows))))


def best_of_each(found: DataFrame, index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank, vec_id and score from ``found`` (qkey, vkey, score): copies expanded, the query's own id left out.

    Ties go to the smaller id.
    """
    top = Window.partitionBy("qkey").orderBy(F.desc("score"), "least")
    ranked = found.join(index.select("vkey", "ids", F.col("ids")[0].alias("least")), "vkey").withColumn("place", F.row_number().over(top)).where(F.col("place") <= k + 1)
    rows = ranked.select("qkey", "score", F.explode("ids").alias("vec_id"))
    rows = rows.withColumn("place", F.row_number().over(Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id"))).where(F.col("place") <= k + 1).drop("place")
    # Written first, so that a vector that many queries hold is split between tasks.
    pairs = checkpointed(rows).join(queries.select(F.col("id").alias("query_id"), F.col("vkey").alias("qkey")), "qkey").where("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    out = pairs.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int"), "vec_id", "score")
