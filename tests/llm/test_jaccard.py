"""The exact Jaccard join against all pairs of shingle sets."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from isobar.llm import jaccard, queries


def plain_sets(rows: list[tuple], size: int = 4) -> list[set]:
    out = []
    for _, text in rows:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
        out.append({tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1))} if words else set())
    return out


def plain_components(rows: list[tuple], percent: int = 85, size: int = 4) -> list[tuple]:
    sets = plain_sets(rows, size)
    root = list(range(len(rows)))

    def find(x: int) -> int:
        while root[x] != x:
            x = root[x]
        return x

    by_shingle: dict = {}
    for k, own in enumerate(sets):
        for shingle in own:
            by_shingle.setdefault(shingle, []).append(k)
    pairs = {(a, b) for group in by_shingle.values() for x, a in enumerate(group) for b in group[x + 1 :]}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(b)] = find(a)
    least: dict = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(least.get(find(k), i), i)
    return sorted(((i, len(sets[k]), least.get(find(k))) for k, (i, _) in enumerate(rows)), key=repr)


def found(df, **how) -> list[tuple]:
    out = jaccard.jaccard_components(df, **how)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def varied(rng: random.Random, words: list[str], changes: int) -> str:
    words = list(words)
    for _ in range(changes if len(words) > 8 else min(changes, 2)):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(2))]
    return " ".join(words)


def corpus(seed: int, rows: int) -> list[tuple]:
    """Templates with few and many changes, one of them a third of all rows, a passage that many texts share, chains, copies and texts alone."""
    rng = random.Random(seed)
    templates = [[f"w{rng.randrange(400)}" for _ in range(rng.choice([3, 5, 20, 60, 150]))] for _ in range(8)] + [[f"w{rng.randrange(400)}" for _ in range(80)]]
    passage = [f"p{k}" for k in range(40)]
    out = []
    for k in range(rows):
        kind = rng.random()
        if kind < 0.33:
            text = varied(rng, templates[-1], rng.randrange(8))
        elif kind < 0.6:
            text = varied(rng, rng.choice(templates), rng.randrange(12))
        elif kind < 0.8:
            text = " ".join([*passage, *(f"w{rng.randrange(400)}" for _ in range(rng.randrange(25)))])
        else:
            text = " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(50)))
        out.append((k, text.upper() if rng.random() < 0.1 else text))
    return out


@pytest.mark.parametrize("limit", [2_000, 40])
def test_components_equal_those_of_all_pairs(spark, limit):
    rows = corpus(4, 500)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(df, limit=limit) == plain_components(rows)


def test_other_shingles_and_similarities(spark):
    rows = corpus(9, 160)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(df, shingle=2, percent=60) == plain_components(rows, 60, 2)


def test_a_link_exactly_at_the_bound(spark):
    # 17 of 20 shingles shared is 85 of 100; 16 of 19 is less.
    first = [f"a{k}" for k in range(23)]
    rows = [(5, " ".join(first)), (3, " ".join(first[:20])), (7, " ".join(f"b{k}" for k in range(22))), (6, " ".join(f"b{k}" for k in range(19)))]
    want = plain_components(rows)
    assert {w[0]: w[2] for w in want} == {5: 3, 3: 3, 7: 7, 6: 6}
    assert found(spark.createDataFrame(rows, "doc_id long, text string")) == want


def test_odd_rows(spark, odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    assert found(odd) == plain_components(rows)
    assert found(odd.limit(0)) == []
    nulls = [(None, "a b c d e"), (None, "a b c d e"), (None, ""), (4, "only one")]
    assert found(spark.createDataFrame(nulls, "doc_id long, text string")) == plain_components(nulls)


def test_the_query_on_the_given_table(spark, sf, docs):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in queries.op11_jaccard_join(spark, sf).collect()), key=repr)
    assert got == plain_components(rows)


def test_a_cell_is_joined_in_full():
    rng = random.Random(1)
    texts = [text for _, text in corpus(6, 400)] + [" ".join(f"u{rng.randrange(9)}" for _ in range(30)) for _ in range(60)]
    rows = [(k, text) for k, text in enumerate(dict.fromkeys(texts)) if text]
    sets = [jaccard.shingle_set(text, 4) for _, text in rows]
    links = jaccard.join_cell(sets, list(range(len(rows))), 85)
    for a, b in links:
        both = len(np.intersect1d(sets[a], sets[b]))
        assert 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both)
    root = list(range(len(rows)))
    for a, b in links:
        old, new = root[b], root[a]
        assert old != new, "a link between what is linked already"
        root = [new if r == old else r for r in root]
    least = {r: min(k for k in range(len(rows)) if root[k] == r) for r in set(root)}
    want = {i: c for i, _, c in plain_components([(k, t) for k, (_, t) in enumerate(rows)])}
    assert {k: least[root[k]] for k in range(len(rows))} == want


def test_regions_hold_every_link():
    """Of any two documents within eps, one's own region holds both."""
    rng = np.random.default_rng(8)
    points = rng.random((300, 2))
    d = np.minimum(np.abs(points[:, None] - points[None]).sum(axis=2), 1.0)
    pivots, eps = rng.choice(300, 6, replace=False), 0.07
    parts = jaccard.regions(d[pivots], eps)
    for i, j in np.argwhere(d <= eps):
        assert any(part[i] and part[j] for part in parts)
