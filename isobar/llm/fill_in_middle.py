"""Fill-in-middle rewriting of documents, cut between lines by rank and select.

A text's units are its lines, each with its newline. The bytes where a unit
ends are a packed bit vector with a directory of popcounts, a block at a time:
its total popcount is the number of units n, two hashed ranks in 0..n are drawn
for a document, and select on them gives the byte cuts of prefix, middle and
suffix. A second vector of the bytes where characters begin turns byte cuts
into code points by rank. A text is one such pair of vectors, an eighth of its
bytes each, whatever its length.

A null or empty text has no units and stays plain, like a text that holds a
sentinel: what comes out can always be turned back. Ranks come from the id
alone, so repeated rows and rows that repeat an id draw alike; a null id draws
as the empty id. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import map_texts, text_or_empty

#: Bits whose popcounts are one entry of a directory.
BLOCK = 512


class BitVector:
    """Packed bits with a directory of the ones before each block."""

    def __init__(self, bits: np.ndarray):
        self.packed = np.packbits(bits, bitorder="little")
        counts = np.bitwise_count(np.pad(self.packed, (0, -len(self.packed) % (BLOCK // 8))).reshape(-1, BLOCK // 8)).sum(axis=1, dtype=np.int64)
        self.before = np.concatenate([np.zeros(1, np.int64), np.cumsum(counts)])

    @property
    def ones(self) -> int:
        return int(self.before[-1])

    def _block(self, block: int) -> np.ndarray:
        return self.packed[block * BLOCK // 8 : (block + 1) * BLOCK // 8]

    def rank(self, end: int) -> int:
        """The ones among the first ``end`` bits."""
        block, rest = divmod(end, BLOCK)
        return int(self.before[block]) + (int(np.unpackbits(self._block(block), count=rest, bitorder="little").sum()) if rest else 0)

    def select(self, rank: int) -> int:
        """The place of the ``rank``-th one, counted from 1."""
        block = int(np.searchsorted(self.before, rank)) - 1
        return block * BLOCK + int(np.flatnonzero(np.unpackbits(self._block(block), bitorder="little"))[rank - 1 - int(self.before[block])])


@dataclass(frozen=True)
class Rules:
    """How documents are drawn: shares in per cent, the seed of the hashes, and the sentinels."""

    percent: int = 100
    spm_percent: int = 50
    seed: int = 7
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        marks = self.sentinels
        if len(set(marks)) < 3 or not all(marks):
            raise ValueError("the sentinels must be three different strings")
        # Else the end of one with what stands behind it could make another.
        if any(a != b and a in b or any(a.endswith(b[:k]) for k in range(1, min(len(a), len(b)))) for a in marks for b in marks):
            raise ValueError("no sentinel may end as one begins")

    @property
    def sentinels(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle

    def drawn(self, id_: str) -> list[int]:
        """Four numbers of 32 bits for an id."""
        digest = hashlib.sha256(f"{self.seed}:{id_}".encode()).digest()
        return [int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4)]


def rewritten(id_: str, text: str, rules: Rules) -> tuple[int, str, int | None, int | None, str]:
    """n, form, code points of prefix and middle, and the text in its form."""
    data = text.encode()
    raw = np.frombuffer(data, np.uint8)
    ends = raw == 10
    if len(ends):
        ends[-1] = True
    units = BitVector(ends)
    n, (h1, h2, h3, h4) = units.ones, rules.drawn(id_)
    if not text or h3 % 100 >= rules.percent or any(mark in text for mark in rules.sentinels):
        return n, "plain", None, None, text
    first, second = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = (units.select(rank) + 1 if rank else 0 for rank in (first, second))
    characters = BitVector((raw & 0xC0) != 0x80)
    before, until = characters.rank(a), characters.rank(b)
    prefix, middle, suffix = data[:a].decode(), data[a:b].decode(), data[b:].decode()
    if h4 % 100 < rules.spm_percent:
        return n, "spm", before, until - before, f"{rules.suffix}{suffix}{rules.prefix}{prefix}{rules.middle}{middle}"
    return n, "psm", before, until - before, f"{rules.prefix}{prefix}{rules.suffix}{suffix}{rules.middle}{middle}"


def fill_in_middle(docs: DataFrame, rules: Rules = Rules(), id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, n (units), form (plain, psm or spm), prefix_chars, middle_chars (code points; null if plain) and output (the text in its form) of every row.

    psm is prefix, suffix, middle, each behind its sentinel; spm is suffix,
    prefix, middle. ``keep`` must not name a column as one of these.
    """
    fields = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType()), T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    kept = [F.col(f"`{name}`").alias(f"k{k}") for k, name in enumerate(keep)]
    id_ = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    # The id stands before the text, with its length, so that one column carries both.
    rows = docs.select(*kept, F.concat(F.length(id_).cast("string"), F.lit(":"), id_, text_or_empty(f"`{text_col}`")).alias("both"))

    def start():
        def make(rows: list[str]) -> list:
            out = []
            for row in rows:
                width, _, rest = row.partition(":")
                out.append(rewritten(rest[: int(width)], rest[int(width) :], rules))
            return [pa.array(column, kind) for column, kind in zip(zip(*out, strict=True) if out else [()] * 5, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]

        return make

    found = map_texts(rows, [f"k{k}" for k in range(len(keep))], F.col("both"), start, fields)
    return found.select(*[F.col(f"k{k}").alias(name) for k, name in enumerate(keep)], *[f.name for f in fields])


def restored(output: Column, form: Column, rules: Rules = Rules()) -> Column:
    """The original text from ``output`` and ``form`` alone."""
    def behind(text: Column, mark: str) -> tuple[Column, Column]:
        parts = F.split(text, re.escape(mark), 2)
        return parts[0], parts[1]

    def three(first: str, second: str) -> tuple[Column, Column, Column]:
        one, rest = behind(F.substring(output, F.lit(len(first) + 1), F.length(output)), second)
        return one, *behind(rest, rules.middle)

    psm, spm = three(rules.prefix, rules.suffix), three(rules.suffix, rules.prefix)
    return F.when(form == "psm", F.concat(psm[0], psm[2], psm[1])).when(form == "spm", F.concat(spm[1], spm[2], spm[0])).otherwise(output)
