"""SimHash classes, near-dedup and repeated strings against brute force."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from isobar.llm import components, queries, simhash, suffix
from llm.conftest import CLASHING, ODD


def classes_of(n, alike):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            a, b = find(i), find(j)
            if a != b and alike(i, j):
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_classes(found, rows):
    prints = [fingerprint(t) for _, t in rows]
    roots = classes_of(len(rows), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    least = {r: min((rows[k][0] for k in range(len(rows)) if roots[k] == r and rows[k][0] is not None), default=None) for r in set(roots)}
    assert Counter((r.doc_id, f"{r.fp % 2**64:016x}", r.component_id) for r in found) == Counter((i, f"{p:016x}", least[r]) for (i, _), p, r in zip(rows, prints, roots, strict=True))


def test_simhash_query(spark, sf, texts):
    rows = list(texts.items())
    found = queries.op6_simhash(spark, sf).collect()
    assert all(len(r.fingerprint) == 16 for r in found)
    prints = {i: fingerprint(t) for i, t in rows}
    roots = classes_of(len(rows), lambda i, j: (prints[rows[i][0]] ^ prints[rows[j][0]]).bit_count() <= 3)
    want = {rows[k][0]: (f"{prints[rows[k][0]]:016x}", min(rows[j][0] for j in range(len(rows)) if roots[j] == roots[k])) for k in range(len(rows))}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in found} == want


def test_simhash_of_odd_rows(odd):
    check_classes(simhash.simhash_classes(odd).collect(), ODD)
    assert simhash.simhash_classes(odd.limit(0)).count() == 0


@pytest.mark.parametrize("limit", [4096, 3])
def test_links_connect_all_within_the_radius(spark, limit):
    rnd = random.Random(9)
    values = [rnd.getrandbits(64) for _ in range(40)]
    for v in values[:20]:
        for _ in range(6):
            v ^= sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))
            values.append(v)
    values = sorted(set(values) | {0, 7, (1 << 64) - 1})
    links = simhash.hamming_links(spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long"), 3, limit)
    got = {r.node % 2**64: r.root for r in components.connected_components(links).collect()}
    roots = classes_of(len(values), lambda i, j: (values[i] ^ values[j]).bit_count() <= 3)
    mine = [got.get(v, simhash.signed(v)) for v in values]
    assert len(set(mine)) == len(set(roots)) and all((mine[i] == mine[j]) == (roots[i] == roots[j]) for i in range(len(values)) for j in range(i))


def test_bk_tree_finds_all_within_the_radius():
    rnd = random.Random(2)
    values = [rnd.getrandbits(12) for _ in range(300)]
    tree = simhash.BKTree()
    for v in values:
        tree.add(v)
    for q in values[:50]:
        assert sorted(tree.within(q, 2)) == [k for k, v in enumerate(values) if (v ^ q).bit_count() <= 2]


def test_components_of_a_path_and_loops(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    assert {r.node: r.root for r in components.connected_components(edges).collect()} == {i: 0 for i in range(31)} | {100: 100, 101: 100}
    assert components.connected_components(edges.limit(0)).count() == 0


def jaccard_classes(rows, shingle, least):
    sets = [frozenset(simhash.shingle_hashes(t or "", shingle).tolist()) for _, t in rows]

    def alike(i, j):
        a, b = sets[i], sets[j]
        both = len(a & b)
        return not a and not b or both >= least * (len(a) + len(b) - both)

    return classes_of(len(rows), alike)


@pytest.mark.parametrize("limit", [2000, 1])
def test_near_dedup_keeps_the_first_of_each_class(docs, texts, limit):
    rows = sorted(texts.items())
    roots = jaccard_classes(rows, 5, 0.8)
    found = simhash.simhash_dedup(docs, key_limit=limit)
    assert found.columns == docs.columns
    assert sorted(r.doc_id for r in found.collect()) == sorted({rows[r][0] for r in roots})


def test_near_dedup_of_planted_copies(spark):
    rnd = random.Random(1)
    rows = []
    for i in range(12):
        words = ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(200)]
        rows.append((i * 10, " ".join(words)))
        for j, edits in enumerate((0, 1, 3, 8, 40)):
            copy = list(words)
            for k in rnd.sample(range(200), edits):
                copy[k] = "zz"
            rows.append((i * 10 + 1 + j, " ".join(copy)))
    roots = jaccard_classes(rows, 5, 0.8)
    for rows_sent in (1_000_000, 0):
        found = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), broadcast_rows=rows_sent)
        assert sorted(r.doc_id for r in found.collect()) == sorted({rows[r][0] for r in roots})


def test_near_dedup_of_lines_repeated_unequally(spark):
    rnd = random.Random(3)

    def words(n):
        return " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(n))

    rows = []
    for i in range(20):
        body, line = words(105), words(5)
        rows += [(10 * i, f"{body} {line}"), (10 * i + 1, " ".join([body] + [line] * 50))]
    roots = jaccard_classes(rows, 5, 0.8)
    assert len(set(roots)) == 20
    found = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in found.collect()) == sorted({rows[r][0] for r in roots})


def test_near_dedup_of_phrases_repeated_behind_a_text(spark):
    rnd = random.Random(13)

    def words(n):
        return " ".join("".join(rnd.choices("abcdefgh", k=5)) for _ in range(n))

    rows = []
    for i in range(40):
        body, phrase = words(150), words(6)
        rows += [(10 * i, body), (10 * i + 1, " ".join([body] + [phrase] * 150))]
    assert len(set(jaccard_classes(rows, 5, 0.8))) == 40
    found = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in found.collect()) == [10 * i for i in range(40)]


@pytest.mark.parametrize("limit", [2000, 2])
def test_near_dedup_of_pairs_that_meet_in_hot_groups_only(spark, limit):
    """Pairs at the threshold beside a passage that every text holds, and a large group of near copies."""
    rnd = random.Random(4)

    def words(n):
        return ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(n)]

    passage, rows = words(30), []
    for _ in range(12):
        own = words(60)
        rows += [(len(rows) + k, " ".join([*passage, *own[: 60 - 9 * k], *words(9 * k)])) for k in range(2)]
    centre = words(90)
    for _ in range(40):
        at = rnd.randrange(90)
        rows.append((len(rows), " ".join([*centre[:at], *words(1), *centre[at + 1 :]])))
    rows += [(1000 + i, " ".join([*passage, *words(40)])) for i in range(12)]
    roots = jaccard_classes(rows, 5, 0.8)
    assert 24 < len(set(roots)) < 40
    found = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string"), key_limit=limit, broadcast_rows=1_000_000 if limit > 2 else 0)
    assert sorted(r.doc_id for r in found.collect()) == sorted({rows[r][0] for r in roots})


def test_minima_meet_wherever_sets_are_similar():
    """The share of pairs at the threshold that share no minimum is far below what these pairs could show; sharing itself is as likely as similarity."""
    rng = np.random.default_rng(6)
    shared, none = [], 0
    for _ in range(3000):
        pool = rng.integers(0, 1 << 63, 110, dtype=np.uint64)
        a, b = simhash._minima(np.sort(pool[:100])), simhash._minima(np.sort(pool[10:]))  # 90 of 110: 0.818
        shared.append((a == b).mean())
        none += not (a == b).any()
    assert none == 0 and abs(np.mean(shared) - 90 / 110) < 0.01


def test_sketches_hold_for_similar_sets():
    rnd = np.random.default_rng(5)
    for _ in range(300):
        n = int(rnd.integers(1, 200))
        pool = np.unique(rnd.integers(0, 1 << 63, n + 20, dtype=np.uint64))
        a, b = np.sort(pool[:n]), np.sort(pool[int(rnd.integers(0, 6)) : n + int(rnd.integers(0, 6))])
        both = len(np.intersect1d(a, b))
        counts = [np.frombuffer(simhash._sketch(x), np.uint8)[None] for x in (a, b)]
        counts = [simhash._folded(c, min(x.shape[1] for x in counts)) for c in counts]
        assert np.abs(counts[0] - counts[1]).sum() <= len(a) + len(b) - 2 * both
        assert simhash.similar(a, b, 0.8) == (both >= 0.8 * (len(a) + len(b) - both))


def test_overlaps_and_forests():
    rng = np.random.default_rng(11)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 40), dtype=np.uint64)) for _ in range(30)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets] for a in sets])
    for columns in (7, 4096):
        assert (simhash.overlaps(sets, columns) == want).all()
    alike = (want >= 14) & ~np.eye(30, dtype=bool)
    roots = classes_of(30, lambda i, j: bool(alike[i, j]))
    assert sorted(simhash.forest(alike)) == [(i, r) for i, r in enumerate(roots) if i != r]


def test_near_dedup_of_odd_rows(odd):
    order = sorted(range(len(ODD)), key=lambda k: (ODD[k][0] is None, ODD[k][0] or 0))
    rows = [ODD[k] for k in order]
    roots = jaccard_classes(rows, 5, 0.8)
    named = odd.withColumns({c: F.lit(c) for c in CLASHING if "." not in c}).withColumnRenamed("a.b", "c.d")
    kept = simhash.simhash_dedup(named).collect()
    assert len(kept) == len(set(roots)) and named.columns == kept[0].__fields__
    assert all(r[c] == c for r in kept for c in CLASHING if "." not in c)
    assert Counter(r.doc_id for r in kept) == Counter(rows[r][0] for r in set(roots))
    assert simhash.simhash_dedup(odd.limit(0)).count() == 0


def repeated(rows, threshold):
    seen = Counter()
    for _, t in rows:
        data = (t or "").encode()
        seen.update(data[s : s + threshold] for s in range(len(data) - threshold + 1))
    out = []
    for i, t in rows:
        data = (t or "").encode()
        gone = bytearray(len(data))
        for s in range(len(data) - threshold + 1):
            if seen[data[s : s + threshold]] > 1:
                gone[s : s + threshold] = b"\1" * threshold
        runs = sum(1 for k in range(len(data)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(data), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(data, gone, strict=True) if not g)).hexdigest()))
    return Counter(out)


def passages(rnd):
    base = "".join(rnd.choices("abcdé ", k=3000))
    rows = []
    for i in range(50):
        text = ""
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randint(0, 2900)
            text += base[at : at + rnd.choice([150, 199, 200, 201, 220, 260, 400])] + "".join(rnd.choices("xyz", k=rnd.randint(0, 30)))
        rows.append((i if i % 7 else None, text))
    return [*rows, (100, "a" * 500), (101, "a" * 200), (102, "ab" * 300), (103, None), (104, ""), (105, rows[3][1]), (105, rows[3][1]), (None, rows[3][1])]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("sent,split", [(64 << 20, 100_000), (0, 2)])
def test_repeated_strings(spark, monkeypatch, seed, sent, split):
    monkeypatch.setattr(suffix, "BROADCAST_BYTES", sent)
    monkeypatch.setattr(suffix, "SPLIT_ROWS", split)
    rows = passages(random.Random(seed))
    found = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), outputs=("kept_sha256",))
    assert Counter(map(tuple, found.collect())) == repeated(rows, 200)


def test_repeated_strings_query(spark, sf, texts):
    assert Counter(map(tuple, queries.op7_repeated_substrings(spark, sf).collect())) == repeated(list(texts.items()), 200)


def test_repeated_strings_of_odd_rows(odd):
    found = suffix.remove_repeats(odd, outputs=("kept_sha256", "kept", "spans")).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found) == repeated(ODD, 200)
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in found)
    assert suffix.remove_repeats(odd.limit(0)).count() == 0
    named = odd.withColumns({c: F.lit(c) for c in CLASHING if "." not in c})
    left = suffix.without_repeats(named, count_col="n_chars").collect()
    assert named.columns == left[0].__fields__ and all(r[c] == c for r in left for c in CLASHING if "." not in c)
    assert Counter((r.doc_id, r.text) for r in left) == Counter((r.doc_id, r.kept) for r in found) and all(r.n_chars == len(r.text) for r in left)


def test_no_group_of_a_hot_passage_is_larger_than_the_limit(spark, monkeypatch):
    rnd = random.Random(8)
    passage = "".join(rnd.choices("abcdefgh", k=260))
    rows = [(i, "".join(rnd.choices("xyz", k=250)) + passage + "".join(rnd.choices("uvw", k=250))) for i in range(40)]
    monkeypatch.setattr(suffix, "SPLIT_ROWS", 10)
    largest, split = [], suffix._split

    def watched(*args):
        cuts, spans = split(*args)
        largest.append(max(r["count"] for r in cuts.groupBy("gram").count().collect()))
        return cuts, spans

    monkeypatch.setattr(suffix, "_split", watched)
    found = suffix.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), outputs=("kept_sha256",))
    assert Counter(map(tuple, found.collect())) == repeated(rows, 200)
    assert largest and largest[0] <= 10


def test_stretches_cover_every_window():
    for reach in (0, 1, 7, 20, 168, 500):
        edges = suffix._stretches(reach)
        assert [b for low, high in edges for b in range(low, high)] == list(range(reach + 1))


def test_whole_characters_stay():
    data = "aé".encode() + b"bbb" + "éc".encode()
    assert suffix.without(data, [(2, 7)], whole_characters=True).decode() == "aééc"
    assert suffix.without(data, [(2, 7)]) == data[:2] + data[7:]
