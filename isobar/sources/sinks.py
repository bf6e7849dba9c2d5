"""Partitioned tables with a manifest, and their validation on read-back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_partitioned(df: DataFrame, path: str, partitions: Sequence[str], files: int | None = None) -> None:
    """Replaces only the partitions that ``df`` has; rows of a partition go to one task, or to several where they are many, or to ``files`` of them.

    The committer renames finished files, so a reader never sees half a partition's file.
    """
    keys = [F.col(p) for p in partitions]
    dealt = df.hint("rebalance", *partitions) if files is None else df.withColumn("__deal", F.pmod(F.xxhash64(*[c for c in df.columns]), F.lit(files))).repartition(*keys, "__deal").drop("__deal")
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def manifest(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """status and row_count of each partition, as written."""
    return df.groupBy(*partitions).agg(F.count("*").alias("row_count")).withColumn("status", F.lit("ok"))


def validate(spark: SparkSession, path: str, manifests: DataFrame, schema: T.StructType, partitions: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """A row for each partition that fails: its counts differ, its key is not unique, or its columns are not those of the schema."""
    stored = spark.read.parquet(path)
    missing = [f.name for f in schema if f.name not in stored.columns]
    extra = [c for c in stored.columns if c not in schema.names and c not in partitions]
    counted = stored.groupBy(*partitions).agg(F.count("*").alias("stored_rows"), F.countDistinct(F.struct(*unique)).alias("keys"))
    both = manifests.join(counted, list(partitions), "full")
    problems = F.array_compact(F.array(
        F.when(F.col("status").isNull() | (F.col("status") != "ok"), "status"),
        F.when(~F.col("row_count").eqNullSafe(F.col("stored_rows")), "row_count"),
        F.when(F.col("keys") != F.col("stored_rows"), "duplicate_key"),
        F.lit(f"missing columns {missing}" if missing else None), F.lit(f"extra columns {extra}" if extra else None),
    ))
    return both.withColumn("problems", problems).where(F.size("problems") > 0).select(*partitions, "problems")


def stale_partitions(outputs: DataFrame, inputs: DataFrame, on: Sequence[str]) -> DataFrame:
    """Keys whose output is missing, failed or older than its newest input (columns built_at, status; changed_at)."""
    newest = inputs.groupBy(*on).agg(F.max("changed_at").alias("changed_at"))
    both = newest.join(outputs, list(on), "left")
    return both.where(F.col("built_at").isNull() | (F.coalesce("status", F.lit("")) != "ok") | (F.col("built_at") < F.col("changed_at"))).select(*on)


def write_single(df: DataFrame, path: str) -> None:
    """One Parquet file, for tables that are small by their nature."""
    df.coalesce(1).write.mode("overwrite").parquet(path)


def write_metrics(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for tables of metrics."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def safe_text(df: DataFrame, value: str, number: str | None = None) -> DataFrame:
    """A column of mixed values as text, and beside it, where ``number`` names a column, as a number where it is one."""
    text = F.col(value).cast("string")
    out = df.withColumn(value, text)
    return out if number is None else out.withColumn(number, F.col(value).try_cast("double"))


def append_log(df: DataFrame, path: str) -> None:
    """Rows appended to a log of JSON lines; what stands there stays."""
    df.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def reloaded_state(log: DataFrame, by: Sequence[str], reset: str, order: Sequence[str], state: dict[str, Column]) -> DataFrame:
    """Per key the state over its entries since ``reset`` last changed: generation (how many changes before and with it), entries, and ``state``."""
    window = Window.partitionBy(*by).orderBy(*order)
    fresh = F.when(F.lag(reset).over(window).eqNullSafe(F.col(reset)) & (F.row_number().over(window) > 1), 0).otherwise(1)
    marked = log.withColumn("__fresh", fresh).withColumn("generation", F.sum("__fresh").over(window.rowsBetween(Window.unboundedPreceding, 0)))
    found = marked.groupBy(*by, "generation").agg(F.first(reset).alias(reset), F.count("*").alias("entries"), *[c.alias(n) for n, c in state.items()])
    last = found.groupBy(*by).agg(F.max(F.struct("generation", *[c for c in found.columns if c not in (*by, "generation")])).alias("__last"))
    return last.select(*by, "__last.*")


def finalised(log: DataFrame, month: str, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """A log's month: of each key the last entry, so that an interrupted and repeated run counts once."""
    last = log.groupBy(month, *key).agg(F.max(F.struct(*order, *[c for c in log.columns if c not in (month, *key, *order)])).alias("__last"))
    return last.select(month, *key, "__last.*")


def complete_days(df: DataFrame, day: Sequence[str], slot: str, expected: int) -> DataFrame:
    """Per day: the distinct slots, rows, and whether all ``expected`` are there."""
    found = df.groupBy(*day).agg(F.countDistinct(slot).alias("slots"), F.count("*").alias("n"))
    return found.withColumn("complete", F.col("slots") >= expected)
