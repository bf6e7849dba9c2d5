"""The pipeline's stages on planted cases, and as a whole."""

from __future__ import annotations

import random
from collections import Counter

import corpus_pipeline
import numpy as np

from isobar.llm import quality, suffix
from isobar.llm.common import tokenizer_path
from llm.test_duplicates import jaccard_classes
from llm.test_tokens import check_packing, library


def test_stages_of_planted_documents(spark, sf, tmp_path):
    rnd = random.Random(6)

    def prose(n):
        return " ".join(("".join(rnd.choices("etaoinshr", k=rnd.randint(2, 8))) + rnd.choice(["", "", ".", ","])).capitalize() if rnd.random() < 0.1 else "".join(rnd.choices("etaoinshr", k=rnd.randint(2, 8))) for _ in range(n))

    passage = prose(70)
    rows = [(i, prose(150)) for i in range(40)] + [(100 + i, f"{prose(120)} {passage} {prose(120)}") for i in range(3)]
    rows += [(200, rows[0][1]), (201, rows[1][1] + " end"), (300, ("BUY!! NOW!! " * 150).strip()), (301, " ".join(w + "###" for w in prose(120).split())), (302, "word " * 400)]
    rows += [(400 + i, ("BUY!! NOW!! " * (50 + i)).strip() + f" {i}") for i in range(40)] + [(500 + i, prose(130)) for i in range(40)]
    labels = [(i, 1, 0) for i, _ in rows if i < 200 or i >= 500] + [(i, 0, 0) for i, _ in rows if 400 <= i < 500]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = {r.doc_id: r for r in docs.collect()} if name != "packing" else docs.collect()
    clean = {i for i, _ in rows if i < 200 or i >= 500}
    assert clean <= set(seen["quality"]) and not any(400 <= i < 500 for i in seen["quality"])
    assert clean <= set(seen["near_dedup"]) and not {200, 201} & set(seen["near_dedup"])
    left = seen["repeats"]
    assert set(left) == set(seen["near_dedup"])
    assert all(passage[20:-20] not in r.text and r.n_chars == len(r.text) for r in left.values())
    assert all(left[i].text == t for i, t in rows if i < 40)
    check_packing(seen["packing"], [(i, [*library("byte_bpe_50k.json", r.text), 0]) for i, r in left.items()], 1024)
    assert tokenizer_path("byte_bpe_50k.json")


def test_run_equals_a_replay_in_memory(spark, sf, docs, texts):
    """Every stage by brute force over Python lists: scores one text at a time, all pairs of sets, all windows of bytes, the library's ids."""
    model = quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    rows = sorted(texts.items())
    scores = model.score(np.array([quality.statistics(t or "") for _, t in rows]))
    rows = [r for r, score in zip(rows, scores, strict=True) if score >= 0.3]
    roots = jaccard_classes(rows, 5, 0.8)
    rows = [rows[k] for k in sorted(set(roots))]
    seen = Counter()
    for _, t in rows:
        data = (t or "").encode()
        seen.update(data[s : s + 200] for s in range(len(data) - 199))
    left = []
    for i, t in rows:
        data = (t or "").encode()
        spans = suffix.merged([(s, s + 200) for s in range(len(data) - 199) if seen[data[s : s + 200]] > 1])
        left.append((i, suffix.without(data, spans, whole_characters=True).decode()))
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 4 and corpus_pipeline.ORACLE_SQL is None
    found = corpus_pipeline.run(spark, sf).collect()
    assert len({r.doc_id for r in found}) == len(left) < len(texts)
    check_packing(found, [(i, [*library("byte_bpe_50k.json", t), 0]) for i, t in left], 1024)


def test_stages_of_odd_rows(spark, odd, tmp_path):
    """Nulls, empty and long texts, repeated rows and clashing names go through every stage; an empty table too."""
    spark.createDataFrame([(1, 1, 0), (4, 1, 0), (8, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for k, start in enumerate((odd, odd.limit(0))):
        rows = start
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, str(tmp_path))
            assert out.columns == odd.columns
            out.write.parquet(f"{tmp_path}/{k}-{name}")
            rows = spark.read.parquet(f"{tmp_path}/{k}-{name}")
        assert corpus_pipeline.STAGES[-1][1](spark, rows, str(tmp_path)).count() >= rows.count()
