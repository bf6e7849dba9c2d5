"""Token-id output as sorted-string-table shards.

Documents are keyed by their identifier. A shard holds them in key order, in
blocks of about ``BLOCK_BYTES``; keys in a block are prefix-compressed against
the key before. Behind the blocks stand a sparse index (first key and place of
every block), a Bloom filter over the keys, and a footer of fixed length, so a
lookup reads the footer, asks the filter, binary-searches the index and reads
one block.

    shard   = block* index filter footer
    block   = crc32 of what follows (u32), width of an id in bytes (u8), zstd(entry*)
    entry   = shared (varint), rest (varint), n ids (varint), rest of the key, ids
    index   = (key length (varint), key, offset (u64), length (u32), entries (u32))*
    footer  = offset and length of index and filter, entries, ids (6 x u64), magic

An integer key is its sign-flipped big-endian form, a string key its UTF-8
bytes, so byte order is Spark's order; a null identifier is the empty key and
comes first. All numbers are little-endian otherwise.

Rows that repeat an identifier are all stored, in the order of their texts'
hashes; where very many rows share both, they are dealt by a further number. A null text is an empty document. An empty table writes no shard and
reads back as an empty result. Other columns are ignored. Texts of any length
are stored whole; a document larger than a block has a block of its own.
"""

from __future__ import annotations

import bisect
import os
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isobar.llm.bpe import encoder
from isobar.llm.common import checkpointed, in_parts, text_or_empty

MAGIC = b"IDSSTBL1"
BLOCK_BYTES = 64 << 10
SHARD_BYTES = 64 << 20
BITS_PER_KEY, PROBES = 10, 7
#: Tasks that read shards, unless there are fewer shards.
MOST_READERS = 10_000
FOOTER = struct.Struct("<6Q8s")
PLACE = struct.Struct("<QII")
MANIFEST = "part int, seq int, path string, entries long, ids long, bytes long, first_key binary, last_key binary"


def key_of(value) -> bytes:
    if value is None or value != value:
        return b""
    return value.encode() if isinstance(value, str) else struct.pack(">Q", int(value) + (1 << 63))


def value_of(key: bytes, is_text: bool):
    if not key:
        return None
    return key.decode() if is_text else struct.unpack(">Q", key)[0] - (1 << 63)


def varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        byte = data[at]
        at += 1
        n |= (byte & 127) << shift
        if byte < 128:
            return n, at
        shift += 7


def bloom_places(key: bytes, bits: int) -> list[int]:
    h = xxhash.xxh3_128_intdigest(key)
    first, step = h & (1 << 64) - 1, h >> 64 | 1
    return [(first + i * step) % bits for i in range(PROBES)]


#: Schemes that Hadoop and Arrow call by other names.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss", "gcs": "gs"}


def file_system(uri: str):
    """The Arrow file system of a URI as Spark writes it, and the path in it.

    Local, s3a, gs, abfs and hdfs folders (the last needs the cluster's libhdfs
    on the workers).
    """
    from pyarrow import fs

    scheme, found, rest = uri.partition("://")
    if not found:
        scheme, _, rest = uri.partition(":") if uri.startswith("file:") else ("file", "", uri)
        return fs.FileSystem.from_uri(f"file://{rest}")
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")


class ShardWriter:
    """Writes one shard; keys must come in order. The file appears under its name only when it is whole."""

    def __init__(self, uri: str, block_bytes: int = BLOCK_BYTES):
        self.uri, self.block_bytes = uri, block_bytes
        self.fs, self.path = file_system(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.temp = f"{self.path}.{uuid.uuid4().hex}.tmp"
        self.out = self.fs.open_output_stream(self.temp)
        self.index: list[tuple[bytes, int, int, int]] = []
        self.keys: list[bytes] = []
        self.entries = self.ids = self.size = 0
        self.pending: list[tuple[bytes, np.ndarray]] = []
        self.pending_bytes = 0

    def add(self, key: bytes, ids: bytes) -> None:
        """ids: little-endian unsigned 32-bit integers."""
        self.pending.append((key, np.frombuffer(ids, "<u4")))
        self.pending_bytes += len(key) + len(ids)
        self.entries += 1
        self.ids += len(ids) // 4
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
        if self.pending_bytes >= self.block_bytes:
            self._flush()

    def _flush(self) -> None:
        if not self.pending:
            return
        width = 2 if max((int(ids.max()) for _, ids in self.pending if len(ids)), default=0) < 1 << 16 else 4
        parts, before = [], b""
        for key, ids in self.pending:
            shared = len(os.path.commonprefix([before, key]))
            parts += [varint(shared), varint(len(key) - shared), varint(len(ids)), key[shared:], ids.astype(f"<u{width}").tobytes()]
            before = key
        body = bytes([width]) + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))
        block = struct.pack("<I", zlib.crc32(body)) + body
        self.index.append((self.pending[0][0], self.size, len(block), len(self.pending)))
        self._write(block)
        self.pending, self.pending_bytes = [], 0

    def _write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def close(self) -> tuple:
        self._flush()
        index_at = self.size
        self._write(b"".join(varint(len(k)) + k + PLACE.pack(*place) for k, *place in self.index))
        filter_at = self.size
        bits = max(64, -(-len(self.keys) * BITS_PER_KEY // 8) * 8)
        bloom = bytearray(bits // 8)
        for key in self.keys:
            for place in bloom_places(key, bits):
                bloom[place >> 3] |= 1 << (place & 7)
        self._write(bytes(bloom))
        self._write(FOOTER.pack(index_at, filter_at - index_at, filter_at, len(bloom), self.entries, self.ids, MAGIC))
        self.out.close()
        self.fs.move(self.temp, self.path)
        return self.uri, self.entries, self.ids, self.size, self.keys[0], self.keys[-1]


class ShardReader:
    """Looks up one key, or goes through a whole shard in key order."""

    def __init__(self, uri: str):
        system, path = file_system(uri)
        self.file = system.open_input_file(path)
        end = self.file.size()
        index_at, index_len, filter_at, filter_len, self.entries, self.ids, magic = FOOTER.unpack(self._read(end - FOOTER.size, FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a shard")
        index = self._read(index_at, index_len)
        self.bloom = self._read(filter_at, filter_len)
        self.first, self.places, at = [], [], 0
        while at < len(index):
            n, at = read_varint(index, at)
            self.first.append(index[at : at + n])
            self.places.append(PLACE.unpack_from(index, at + n))
            at += n + PLACE.size

    def _read(self, at: int, n: int) -> bytes:
        return self.file.read_at(n, at)

    def _block(self, k: int) -> Iterator[tuple[bytes, np.ndarray]]:
        offset, length, entries = self.places[k]
        block = self._read(offset, length)
        if zlib.crc32(block[4:]) != struct.unpack_from("<I", block)[0]:
            raise ValueError("a block is damaged")
        width, data = block[4], zstandard.ZstdDecompressor().decompress(block[5:])
        at, key = 0, b""
        for _ in range(entries):
            shared, at = read_varint(data, at)
            rest, at = read_varint(data, at)
            n, at = read_varint(data, at)
            key = key[:shared] + data[at : at + rest]
            at += rest
            yield key, np.frombuffer(data, f"<u{width}", n, at)
            at += n * width

    def __iter__(self) -> Iterator[tuple[bytes, np.ndarray]]:
        for k in range(len(self.places)):
            yield from self._block(k)

    def get(self, value) -> list[np.ndarray]:
        """The ids of all documents under this identifier."""
        key = key_of(value)
        if not all(self.bloom[p >> 3] >> (p & 7) & 1 for p in bloom_places(key, len(self.bloom) * 8)):
            return []
        out: list[np.ndarray] = []
        for k in range(max(0, bisect.bisect_left(self.first, key) - 1), len(self.first)):
            if self.first[k] > key:
                break
            out += [ids for own, ids in self._block(k) if own == key]
        return out


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = None, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Encodes ``docs`` and writes them under ``path`` in ascending order of ``id_col``.

    Rows are dealt by ranges of (identifier, text hash), so a range is one
    task's and its shards follow one another. Returns the manifest, already
    written: a row for each shard, in key order by (part, seq).
    """
    end = b"" if end_id is None else struct.pack("<I", end_id)
    # Rows equal in id and text are alike, so any order among them will do: the last number lets ranges cut them.
    order = ["__id", "__hash", "__any"]
    rows = docs.select(F.col(id_col).alias("__id"), text_or_empty(text_col).alias("__text")).withColumns({"__hash": F.xxhash64("__text"), "__any": F.monotonically_increasing_id()})

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, done, writer, size = TaskContext.get().partitionId(), [], None, 0
        encode = encoder(tokenizer)
        for batch in in_parts(batches):
            for value, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if writer is None:
                    writer, size = ShardWriter(f"{path}/part-{part:06d}-{len(done):05d}.sst"), 0
                writer.add(key_of(value), ids := encode(text) + end)
                size += len(ids)
                if size >= shard_bytes:
                    done.append((part, len(done), *writer.close()))
                    writer = None
        if writer is not None:
            done.append((part, len(done), *writer.close()))
        yield pa.RecordBatch.from_arrays([pa.array([row[k] for row in done], f.type) for k, f in enumerate(manifest)], schema=manifest)

    manifest = to_arrow_schema(T.StructType.fromDDL(MANIFEST))
    sorted_rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("__id", "__text")
    return checkpointed(sorted_rows.mapInArrow(write, MANIFEST))


def read_shards(manifest: DataFrame, id_col: str = "doc_id", id_type: T.DataType = T.LongType(), outputs: tuple[str, ...] = ("ids",)) -> DataFrame:
    """Every document of the shards: its identifier, start (ids of all before it), n_tokens and the named outputs.

    Outputs: ids (array<int>), ids_crc32 (unsigned crc32 of the ids as
    little-endian unsigned 32-bit integers).
    """
    # A row a range comes to the driver, as many as the write had tasks; the shards of a range are summed beside one another.
    totals = [(r.part, r.ids) for r in manifest.groupBy("part").agg(F.sum("ids").alias("ids")).orderBy("part").collect()]
    before = np.cumsum([0, *(ids for _, ids in totals)]).tolist()
    spark = manifest.sparkSession
    parts = spark.createDataFrame([(part, start) for (part, _), start in zip(totals, before, strict=False)], "part int, part_start long")
    own = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    starts = manifest.withColumn("own", F.coalesce(F.sum("ids").over(own), F.lit(0))).join(F.broadcast(parts), "part")
    shards = starts.select("path", (F.col("part_start") + F.col("own")).alias("start")).repartition(max(1, min(manifest.count(), MOST_READERS)), "path")
    kinds = {"ids": T.ArrayType(T.LongType()), "ids_crc32": T.LongType()}
    schema = T.StructType([T.StructField(id_col, id_type), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), *(T.StructField(o, kinds[o]) for o in outputs)])
    make = {"ids": lambda ids: ids.astype("i8"), "ids_crc32": lambda ids: zlib.crc32(ids.astype("<u4").tobytes())}
    is_text = isinstance(id_type, T.StringType)

    arrow = to_arrow_schema(schema)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([row[k] for row in rows], f.type) for k, f in enumerate(arrow)], schema=arrow)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for path, start in (x for batch in batches for x in zip(*(c.to_pylist() for c in batch.columns), strict=True)):
            rows: list[tuple] = []
            held = 0
            for key, ids in ShardReader(path):
                rows.append((value_of(key, is_text), start, len(ids), *(make[o](ids) for o in outputs)))
                start += len(ids)
                held += len(ids)
                if held > 1 << 20:
                    yield batch_of(rows)
                    rows, held = [], 0
            yield batch_of(rows)

    return shards.mapInArrow(read, schema)
