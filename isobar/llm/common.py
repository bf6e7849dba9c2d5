"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

#: Only used in local mode, as in tests, where the session names no folder.
LOCAL_CHECKPOINTS = "/tmp/checkpoints"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; the cluster names it in spark.checkpoint.dir."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named.rstrip("/") if named else f"file://{LOCAL_CHECKPOINTS}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut by a reliable checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` as a table written under ``path``: its lineage is cut, and readers take only the columns they need."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a path of the shared folder, if it is there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def text_or_empty(column: str = "text") -> Column:
    """A null text counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """A 128-bit key of a row's id and text, binary.

    Rows that repeat an id with another text get another key, rows repeated
    in full share one; a null id has a key of its own.
    """
    id_ = F.col(id_col).cast("string")
    return F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.length(id_).cast("string"), F.lit(":"), id_), F.lit("-")), text_or_empty(text_col)).cast("binary")))


def whole_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Iterable[str] | None = None) -> DataFrame:
    """``docs`` as doc (a struct of its columns, or of those in ``carry``), rid (``row_key``), id and text, so that no name of its columns matters; ``doc.*`` gives them back."""
    names = [f"`{name}`" for name in (docs.columns if carry is None else carry)]
    doc = F.struct(*names) if names else F.struct(F.lit(0).alias("none"))
    return docs.select(doc.alias("doc"), row_key(f"`{id_col}`", f"`{text_col}`").alias("rid"), F.col(f"`{id_col}`").alias("id"), text_or_empty(f"`{text_col}`").alias("text"))


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file. Environment variable TOKENIZER_DIR names another folder."""
    if folder := os.environ.get("TOKENIZER_DIR"):
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def in_parts(batches: Iterable[pa.RecordBatch], rows: int = 1_024) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``rows``, so that Python never holds a whole batch of texts at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def map_texts(df: DataFrame, keep: Iterable[str], text: Column, start: Callable[[], Callable[[list[str]], list]], fields: list[T.StructField]) -> DataFrame:
    """The columns ``keep``, untouched, and new columns made from each row's text, in Arrow batches.

    ``start`` runs once a task and returns a function from a batch of texts to
    one list, or Arrow array, for each of ``fields``.
    """
    kept = [df.schema[name] for name in keep]
    schema = T.StructType([*kept, *fields])
    arrow = [to_arrow_type(f.dataType) for f in fields]
    names = [*schema.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        make = start()
        for batch in in_parts(batches):
            columns = make(batch.column(len(kept)).to_pylist())
            new = [values if isinstance(values, pa.Array) else pa.array(values, kind) for values, kind in zip(columns, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], *new], names)

    return df.select(*[F.col(f"`{f.name}`") for f in kept], text.alias("__text")).mapInArrow(run, schema)
