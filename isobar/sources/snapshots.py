"""Tables replaced as a whole: versioned snapshots behind one conditional write.

A commit writes its files into a folder of its own, then asks for the next
version: a JSON manifest that is created only if no one else has. That creation
is the commit. Readers take the manifest with the highest version and the files
that it names, so they see a table as a whole or as it was before; a writer that
fails leaves files that no manifest names, and one that lost the race gets an
error. The file system must create files exclusively (HDFS, local folders, and
object stores with conditional writes).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class LostRace(RuntimeError):
    """Another writer has committed first."""


def _files(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def create_json(spark: SparkSession, path: str, value: dict) -> None:
    """Writes ``value`` as a JSON file that must not exist yet; a lost race is an error."""
    files, hadoop = _files(spark, path)
    try:
        out = files.create(hadoop(path), False)
    except Exception as error:
        if files.exists(hadoop(path)):
            raise LostRace(path) from error
        raise
    try:
        out.write(json.dumps(value, sort_keys=True).encode())
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> dict:
    return json.loads("\n".join(r.value for r in spark.read.text(path, wholetext=True).collect()))


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions that are committed, ascending."""
    files, hadoop = _files(spark, path)
    at = hadoop(f"{path}/versions")
    if not files.exists(at):
        return []
    return sorted(int(name.removesuffix(".json")) for f in files.listStatus(at) if (name := f.getPath().getName()).endswith(".json"))


def commit(df: DataFrame, path: str, based_on: int | None = None, partitions: Sequence[str] = ()) -> int:
    """Makes ``df`` the table at ``path`` and returns its version. With ``based_on`` only if that is still the newest version (0: there is none)."""
    spark = df.sparkSession
    newest = max(versions(spark, path), default=0)
    if based_on is not None and based_on != newest:
        raise LostRace(f"{path} is at version {newest}, not {based_on}")
    folder = f"data/{uuid.uuid4().hex}"
    df.write.partitionBy(*partitions).parquet(f"{path}/{folder}")
    stored = spark.read.schema(df.schema).parquet(f"{path}/{folder}")
    manifest = {"version": newest + 1, "folder": folder, "schema": df.schema.jsonValue(), "partitions": list(partitions), "row_count": stored.count()}
    create_json(spark, f"{path}/versions/{newest + 1:012d}.json", manifest)
    return newest + 1


def manifest(spark: SparkSession, path: str, version: int | None = None) -> dict:
    """A version's manifest; of the newest one that is whole, as a writer may be creating a newer one just now."""
    for v in reversed(versions(spark, path)):
        if version in (None, v):
            try:
                return read_json(spark, f"{path}/versions/{v:012d}.json")
            except json.JSONDecodeError:
                continue
    raise ValueError(f"{path} has no version {version or ''}".strip())


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The newest version, or the one named."""
    found = manifest(spark, path, version)
    return spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(f"{path}/{found['folder']}")


def unnamed_folders(spark: SparkSession, path: str) -> list[str]:
    """Folders of files that no version names: what failed writers left. One that is being written is among them."""
    files, hadoop = _files(spark, path)
    if not files.exists(hadoop(f"{path}/data")):
        return []
    named = set()
    for v in versions(spark, path):
        try:
            named.add(manifest(spark, path, v)["folder"])
        except ValueError:  # is being created
            pass
    return sorted(name for f in files.listStatus(hadoop(f"{path}/data")) if (name := f"data/{f.getPath().getName()}") not in named)

