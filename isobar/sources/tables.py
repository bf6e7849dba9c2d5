"""Parquet scans with optional paths and fixed schemas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, asked of the file system that holds it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    found = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(hadoop)
    return found is not None and len(found) > 0


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` as ``schema``: its columns in order and type, missing ones null, others gone, NaN as null."""
    have = set(df.columns)
    out = []
    for f in schema:
        c = F.col(f"`{f.name}`") if f.name in have else F.lit(None)
        if f.name in have and isinstance(df.schema[f.name].dataType, T.FloatType | T.DoubleType):
            c = F.nanvl(c, F.lit(None))
        out.append(c.cast(f.dataType).alias(f.name, metadata=f.metadata))
    return df.select(out)


def optional_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or an empty one."""
    return conform(spark.read.parquet(path), schema) if exists(spark, path) else spark.createDataFrame([], schema)


def pruned_parquet(spark: SparkSession, path: str, columns: Sequence[str], schema: T.StructType) -> DataFrame:
    """Only the named columns of the table at ``path``; those that it lacks are null, in the type of ``schema``."""
    have = set(spark.read.parquet(path).columns)
    wanted = T.StructType([schema[c] for c in columns])
    return conform(spark.read.parquet(path).select(*[c for c in columns if c in have]), wanted)


def named_parquets(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None, drop_empty: bool = False) -> DataFrame:
    """All files called ``name`` below ``root``, united by column name; empty files give no rows.

    With ``drop_empty`` a column that is null in a whole file counts as absent
    there, and one that is null in all files goes.
    """
    df = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", name).option("mergeSchema", True).parquet(root)
    if drop_empty:
        used = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
        df = df.select(*[F.col(f"`{c}`") for c in df.columns if used[c]])
    return df if schema is None else conform(df, schema)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Heterogeneous frames united by name; a missing column is null."""
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def with_partition_value(df: DataFrame, key: str) -> DataFrame:
    """The value of ``key=...`` in each row's file path, for files read without partition discovery."""
    return df.withColumn(key, F.nullif(F.regexp_extract(F.col("_metadata.file_path"), f"[/=]{key}=([^/]+)/", 1), F.lit("")))


def issue_catalog(manifests: DataFrame, default_path: str = "", root: str = "", folder: str | None = None, present: DataFrame | None = None) -> DataFrame:
    """Issues with status ok: a row for each data path, and when the issue became available.

    Paths are joined by ; in the manifest. A path is absolute, or below
    ``root``, or below the manifest's own ``folder`` column, or the default
    name in it: the first of these that ``present`` (a table of existing paths)
    holds counts, and a row that none holds is left out; without ``present``
    the path stays as it is. Available is the processing time, or the issue's
    own time where that is missing.
    """
    paths = F.explode(F.filter(F.transform(F.split(F.coalesce("wide_output_paths", F.lit(default_path)), ";"), lambda p: F.trim(p)), lambda p: p != ""))
    rows = manifests.where("extraction_status = 'ok'").select("*", paths.alias("data_path")).withColumn(
        "available_utc", F.coalesce(F.try_to_timestamp("processed_timestamp_utc"), F.try_to_timestamp("init_time_utc"))
    )
    if present is None:
        return rows
    below = [F.concat(F.lit(root + "/"), F.col("data_path"))] if root else []
    if folder:
        below += [F.concat(F.col(folder), F.lit("/"), F.col("data_path")), F.concat(F.col(folder), F.lit(f"/{default_path}"))]
    tried = F.array(F.when(F.startswith("data_path", F.lit("/")), F.col("data_path")), *below)
    numbered = rows.withColumn("__row", F.monotonically_increasing_id())
    found = numbered.select("__row", F.posexplode(tried).alias("__place", "path")).join(present.select("path").distinct(), "path")
    first = found.groupBy("__row").agg(F.min_by("path", "__place").alias("resolved_path"))
    return numbered.join(first, "__row").drop("__row")


def distinct_inputs(paths: DataFrame, column: str = "path") -> DataFrame:
    """Input files named more than once, by paths that resolve to the same file: one row each, sorted names of scheme, dots and doubled slashes taken out."""
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.col(column), "^file:(//)?", ""), "/(\\./)+", "/"), "/{2,}", "/")
    resolved = F.aggregate(
        F.split(plain, "/"), F.array().cast("array<string>"),
        lambda out, part: F.when(part == "..", F.slice(out, F.lit(1), F.greatest(F.size(out) - 1, F.lit(1)))).otherwise(F.array_append(out, part)),
    )
    return paths.withColumn("resolved", F.array_join(resolved, "/")).groupBy("resolved").agg(F.min(column).alias(column), F.count("*").alias("named"))
