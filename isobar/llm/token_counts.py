"""Token counts: map-side two-tier lookup.

First tier: a compact table of the lengths of frequent pre-tokens, at most
``TABLE_ENTRIES`` of them, broadcast. They are counted over all texts: a task
keeps a summary of at most ``SUMMARY_ENTRIES`` pre-tokens and takes the least
count off all of them when it is full, so what is frequent stays whatever the
order of the rows; summaries are added up, and only these bounded sums are
shuffled. Second tier: a worker's cache of the pre-tokens that miss, encoded by
the tokenizers library; it outlives the task. The table only saves encoding
work and changes no count.

Nulls, empty texts and empty tables: a null text counts as empty, an empty
text has 0 bytes and 0 tokens, an empty table gives an empty result. Rows with
repeated or null ids each give their own row; other columns are left out
unless named in ``keep``. Texts are taken whole at any length and in any
script.
"""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.bpe import PieceEncoder, encoder
from isobar.llm.common import in_parts, map_texts, text_or_empty

TABLE_ENTRIES = 65_536
#: Pre-tokens of a task's summary, and their characters at most.
SUMMARY_ENTRIES, LONGEST = 65_536, 64


class Summary:
    """Counts of what is frequent in a stream, in bounded memory: every count is too low by at most ``missed``."""

    def __init__(self, entries: int):
        self.entries, self.counts, self.missed = entries, Counter(), 0

    def add(self, pieces: Iterable[str]) -> None:
        self.counts.update(pieces)
        if len(self.counts) > 2 * self.entries:
            self._shrink()

    def _shrink(self) -> None:
        least = sorted(self.counts.values(), reverse=True)[self.entries]
        self.missed += least
        self.counts = Counter({piece: n - least for piece, n in self.counts.items() if n > least})

    def top(self) -> list[tuple[str, int]]:
        return [(piece, n) for piece, n in self.counts.most_common(self.entries) if n > 1 and len(piece) <= LONGEST]


def frequent_lengths(docs: DataFrame, tokenizer: str, text_col: str = "text", entries: int = TABLE_ENTRIES) -> dict[str, int]:
    """Token lengths of the most frequent pre-tokens of all texts; at most ``entries``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen = encoder(tokenizer), Summary(SUMMARY_ENTRIES)
        for batch in in_parts(batches):
            for text in batch.column(0).to_pylist():
                seen.add(encode.pieces(text) or ())
        top = seen.top()
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in top], pa.string()), pa.array([x[1] for x in top], pa.int64())], names=["piece", "n"])

    counted = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    encode = encoder(tokenizer)
    return {row.piece: len(encode.piece(row.piece)) // 4 for row in counted.orderBy(F.desc("n"), "piece").limit(entries).collect()}


class _Lengths(dict):
    """Second tier: what is missing is looked up in the broadcast table, then encoded and kept."""

    limit = 100_000

    def __init__(self, name: str, frequent: dict[str, int], encode):
        super().__init__(frequent)
        self.name, self.frequent, self.encode = name, frequent, encode

    def __missing__(self, piece: str) -> int:
        n = len(self.encode(piece)) // 4
        if len(piece) <= LONGEST:
            if len(self) > len(self.frequent) + self.limit:
                self.clear()
                self.update(self.frequent)
            self[piece] = n
        return n


_held: _Lengths | None = None


def lengths(name: str, frequent: dict[str, int], encode: PieceEncoder) -> _Lengths:
    """The worker's own lookup for the table of this name; another table takes its place."""
    global _held
    if _held is None or _held.name != name:
        _held = _Lengths(name, frequent, encode.piece)
    return _held


def token_counts(docs: DataFrame, tokenizer: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), limit: int = 512, frequent: dict[str, int] | None = None) -> DataFrame:
    """``keep``, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every row."""
    table = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, frequent_lengths(docs, tokenizer, text_col) if frequent is None else frequent))

    def start():
        encode = encoder(tokenizer)
        own = lengths(*table.value, encode)

        def count(text: str) -> int:
            pieces = encode.pieces(text)
            return len(encode.library(text)) // 4 if pieces is None else sum(map(own.__getitem__, pieces))

        return lambda texts: [list(map(count, texts))]

    text = text_or_empty(text_col)
    sized = docs.select(*keep, text.alias("__whole"), F.octet_length(text).cast("long").alias("n_bytes"))
    counted = map_texts(sized, [*keep, "n_bytes"], F.col("__whole"), start, [T.StructField("n_tokens", T.LongType())])
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
