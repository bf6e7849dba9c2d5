"""Encoders, counts, shards and packing against the libraries, one text at a time."""

from __future__ import annotations

import array
import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from isobar.llm import bpe, common, packing, pieces, queries, sstable, token_counts
from llm.conftest import ODD

BYTES, WORDS, PIECES = "byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"


def library(name, text):
    return bpe.encoder(common.tokenizer_path(name)).tokenizer.encode(text or "", add_special_tokens=False).ids


def raw(ids):
    return array.array("I", ids).tobytes()


@pytest.mark.parametrize("name", [BYTES, WORDS])
@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x2FF), st.sampled_from(" \n\t'sdA1<|>é́")), max_size=60))
def test_encoder_equals_the_library(name, text):
    assert bpe.encoder(common.tokenizer_path(name))(text) == raw(library(name, text))


@pytest.mark.parametrize("name", [BYTES, WORDS])
@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(" \n\t'sdA1é’–日本語Привет٣Ⅷ\u2003\u0301\u1100\u1161😀ΣςİK\x1c\x85")), max_size=40))
def test_encoder_equals_the_library_in_all_scripts(name, text):
    assert bpe.encoder(common.tokenizer_path(name))(text) == raw(library(name, text))


@pytest.mark.parametrize("name", [BYTES, WORDS])
def test_every_code_point_has_the_librarys_class(name):
    encode = bpe.encoder(common.tokenizer_path(name))
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(points), 256):
        for text in (" a".join(points[at : at + 256]), "1" + "1!".join(points[at : at + 256])):
            assert encode(text) == raw(library(name, text))


def test_texts_of_any_script_use_the_table():
    encode = bpe.encoder(common.tokenizer_path(BYTES))
    for text in ("it’s – fine", "Привет, мир", "日本語のテキスト。", "emoji 😀 end", "a\u2003b\u0301"):
        pieces = encode.pieces(text)
        assert pieces and "".join(pieces) == text
        assert encode.pieces("<|endoftext|>" + text) is None
    own = token_counts.lengths("a name", {"Привет": 99}, encode)
    assert own["Привет"] == 99 and own[" мир"] == len(library(BYTES, " мир")) and " мир" in own
    assert token_counts.lengths("a name", {}, encode) is own and token_counts.lengths("another", {}, encode) is not own


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x2FF, exclude_categories=["Cs"]), st.sampled_from("   ▁\nab日")), max_size=60))
def test_codec_equals_the_library(text):
    codec = pieces.codec(common.tokenizer_path(PIECES))
    ids = codec.processor.encode(text)
    assert codec(text) == (",".join(map(str, ids)), codec.processor.decode(ids))


def test_counts(spark, sf, texts):
    found = {r.doc_id: r for r in queries.op8_token_counts(spark, sf).collect()}
    for k, text in texts.items():
        n = len(library(BYTES, text))
        assert (found[k].n_bytes, found[k].n_tokens, found[k].over_limit) == (len(text.encode()), n, n > 512)


def test_counts_of_odd_rows(odd):
    found = token_counts.token_counts(odd, common.tokenizer_path(BYTES)).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in found) == Counter((i, len(library(BYTES, t))) for i, t in ODD)
    assert token_counts.token_counts(odd.limit(0), common.tokenizer_path(BYTES)).count() == 0
    assert token_counts.token_counts(odd, common.tokenizer_path(BYTES), frequent={}).where("n_tokens is null").count() == 0


def test_pieces(spark, sf, texts):
    processor = pieces.codec(common.tokenizer_path(PIECES)).processor
    for r in queries.op2_sentencepiece(spark, sf).collect():
        ids = processor.encode(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()


def test_pieces_of_odd_rows(odd):
    processor = pieces.codec(common.tokenizer_path(PIECES)).processor
    found = pieces.encode_pieces(odd, common.tokenizer_path(PIECES)).collect()
    assert Counter((r.doc_id, tuple(r.ids), r.decoded) for r in found) == Counter((i, tuple(ids := processor.encode(t or "")), processor.decode(ids)) for i, t in ODD)
    assert pieces.encode_pieces(odd.limit(0), common.tokenizer_path(PIECES)).count() == 0


def test_shards(spark, sf, texts):
    found = sorted(queries.op4_sstable_output(spark, sf).collect(), key=lambda r: r.doc_id)
    start = 0
    assert [r.doc_id for r in found] == sorted(texts)
    for r in found:
        ids = [*library(WORDS, texts[r.doc_id]), 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(raw(ids)))
        start += len(ids)


def test_shards_of_odd_rows_and_lookups(spark, odd):
    at = common.scratch_path(spark, "test-shards")
    manifest = sstable.write_shards(odd, at, common.tokenizer_path(WORDS), end_id=2, shard_bytes=4096)
    found = sstable.read_shards(manifest).collect()
    shards = manifest.orderBy("part", "seq").collect()
    want = Counter((i, tuple([*library(WORDS, t), 2])) for i, t in ODD)
    assert Counter((r.doc_id, tuple(r.ids)) for r in found) == want
    assert sum(r.ids for r in shards) == sum(len(k[1]) * n for k, n in want.items()) and len(shards) > 1
    assert [r.start for r in sorted(found, key=lambda r: r.start)] == [0, *np.cumsum([r.n_tokens for r in sorted(found, key=lambda r: r.start)]).tolist()[:-1]]
    for value in (None, 1, 4, 5, 99):
        got = [tuple(ids.tolist()) for r in shards for ids in sstable.ShardReader(r.path).get(value)]
        assert Counter(got) == Counter({k[1]: n for k, n in want.items() if k[0] == value})
    empty = sstable.write_shards(odd.limit(0), at + "-empty", common.tokenizer_path(WORDS))
    assert empty.count() == 0 and sstable.read_shards(empty).count() == 0


def test_shards_of_long_text_keys(spark):
    rows = [("k" * 70_000 + str(i), f"text {i}") for i in range(5)] + [("", "empty"), (None, "none"), ("é", "accent")]
    at = common.scratch_path(spark, "test-shards")
    manifest = sstable.write_shards(spark.createDataFrame(rows, "doc_id string, text string"), at, common.tokenizer_path(WORDS))
    from pyspark.sql import types as T

    found = {r.doc_id: tuple(r.ids) for r in sstable.read_shards(manifest, id_type=T.StringType()).collect()}
    assert found == {(k or None): tuple(library(WORDS, t)) for k, t in rows if k != ""} | {None: found[None]} and found[None] in {tuple(library(WORDS, t)) for t in ("empty", "none")}
    reader = [sstable.ShardReader(r.path) for r in manifest.collect()]
    assert [tuple(x.tolist()) for r in reader for x in r.get("é")] == [tuple(library(WORDS, "accent"))]


def test_addresses_of_shared_folders(tmp_path):
    system, path = sstable.file_system(f"file:{tmp_path}/x")
    assert type(system).__name__ == "LocalFileSystem" and path == f"{tmp_path}/x"
    assert sstable.file_system(f"file://{tmp_path}/x")[1] == path == sstable.file_system(f"{tmp_path}/x")[1]
    assert sstable.SCHEMES["s3a"] == "s3"


def test_shard_blocks_and_damage(tmp_path):
    writer = sstable.ShardWriter(f"file://{tmp_path}/a.sst", block_bytes=100)
    rows = [(sstable.key_of(i), struct.pack("<3I", i + 50, 70_000, 1)) for i in range(-50, 50)]
    for row in rows:
        writer.add(*row)
    writer.close()
    reader = sstable.ShardReader(f"file://{tmp_path}/a.sst")
    assert len(reader.places) > 5 and [(k, ids.astype("<u4").tobytes()) for k, ids in reader] == rows
    assert reader.get(-50)[0].tolist()[1:] == [70_000, 1] and reader.get(50) == []
    data = bytearray((tmp_path / "a.sst").read_bytes())
    data[10] ^= 1
    (tmp_path / "b.sst").write_bytes(data)
    with pytest.raises(ValueError):
        list(sstable.ShardReader(f"file://{tmp_path}/b.sst"))


def check_packing(found, documents, capacity):
    """documents: (id, ids) of every row, with the end id."""
    pieces_of, windows = defaultdict(list), defaultdict(list)
    for r in found:
        pieces_of[r.doc_id].append(r)
        windows[r.sequence_id].append(r)
    for rows in windows.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    want = Counter()
    for i, ids in documents:
        for s in range(0, len(ids), capacity):
            want[i, s, len(ids[s : s + capacity]), zlib.crc32(raw(ids[s : s + capacity])), len(ids)] += 1
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in found) == want
    return sum(r.length for r in found) / (capacity * max(1, len(windows)))


def test_packing(spark, sf, texts):
    filled = check_packing(queries.op9_packing(spark, sf).collect(), [(k, [*library(BYTES, t), 0]) for k, t in texts.items()], 1024)
    assert filled > 0.98


def test_packing_of_odd_rows(odd):
    documents = [(i, [*library(BYTES, t), 0]) for i, t in ODD]
    for capacity in (16, 1024):
        check_packing(packing.pack(odd, common.tokenizer_path(BYTES), 0, capacity).collect(), documents, capacity)
    assert packing.pack(odd.limit(0), common.tokenizer_path(BYTES)).count() == 0


def test_filling_has_the_least_slack():
    rnd = random.Random(4)
    for _ in range(200):
        capacity = rnd.randint(5, 40)
        counts = {rnd.randint(1, capacity): rnd.randint(1, 3) for _ in range(rnd.randint(1, 5))}
        one = packing.fill(counts, capacity)
        longest = max(counts)
        assert one[longest] >= 1 and all(n <= counts[k] for k, n in one.items())
        sums = {longest}
        for k, n in counts.items():
            sums = {s + k * t for s in sums for t in range(n + 1 - (k == longest))}
        assert sum(k * n for k, n in one.items()) == max(s for s in sums if s <= capacity)
        used = Counter()
        for filling, times in packing.plan(counts, capacity):
            for k, n in filling.items():
                used[k] += n * times
        assert used == Counter(counts)


def test_what_is_frequent_is_found_wherever_it_stands(spark):
    """The table counts all texts: what only the last rows of a partition repeat is in it."""
    rows = [(k, " ".join(f"rare{k}x{j}" for j in range(30))) for k in range(200)] + [(1000 + k, "zebra quagga " * 20) for k in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = token_counts.frequent_lengths(df, common.tokenizer_path(BYTES), entries=50)
    assert " zebra" in found and " quagga" in found and len(found) <= 50


def test_a_summary_keeps_what_is_frequent_in_bounded_memory():
    import random

    rng, seen, true = random.Random(3), token_counts.Summary(20), {}
    for _ in range(400):
        pieces = [f"hot{rng.randrange(5)}" for _ in range(10)] + [f"cold{rng.randrange(10**6)}" for _ in range(10)]
        seen.add(pieces)
        for p in pieces:
            true[p] = true.get(p, 0) + 1
        assert len(seen.counts) <= 40 + 20
    top = dict(seen.top())
    assert {f"hot{k}" for k in range(5)} <= set(top)
    assert all(true[p] - seen.missed <= n <= true[p] for p, n in top.items())
