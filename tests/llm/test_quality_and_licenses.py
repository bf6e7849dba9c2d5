"""The classifier on held-out labels, and the license scan against brute force."""

from __future__ import annotations

import re
import zlib

import numpy as np

from isobar.llm import licenses, quality, queries
from llm.conftest import ODD

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op10_quality(spark, SF)
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = found.collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    seen = found.join(labels, "doc_id").where("held_out").select("score", "quality", "predicted").collect()
    good = np.array([r.score for r in seen if r.quality == 1])
    bad = np.array([r.score for r in seen if r.quality == 0])
    assert (good[:, None] > bad[None]).mean() > 0.95
    assert np.mean([r.predicted == r.quality for r in seen]) > 0.95


def test_labels_of_held_out_rows_do_not_matter(spark):
    from pyspark.sql import functions as F

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(quality.fold() == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality.fit(docs, labels), quality.fit(docs, turned)
    assert np.allclose(a.weights, b.weights) and np.allclose(a.values, b.values)


def test_odd_rows_and_labels(spark, odd):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (2, 1, 0), (4, 0, None), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    for some in (labels, labels.limit(0)):
        found = quality.score(odd, quality.fit(odd, some)).collect()
        assert len(found) == len(ODD) and all(0 <= r.score <= 1 for r in found)
        kept = quality.keep_good(odd, some)
        assert kept.columns == odd.columns and kept.count() == sum(r.predicted for r in found)
    assert quality.keep_good(odd.limit(0), labels).count() == 0


def test_fit_and_scores_equal_one_solve_of_all_rows(spark):
    """The sums over tasks, the ridge, the calibration and the scores, against NumPy over one matrix."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet").toPandas() for t in ("documents", "labels"))
    model = quality.fit(spark.read.parquet(f"{SF}/documents.parquet").repartition(7), spark.read.parquet(f"{SF}/labels.parquet"))
    rows = docs.merge(labels, on="doc_id").dropna(subset=["quality"])
    fold = np.array([zlib.crc32(str(i).encode()) % 5 for i in rows.doc_id])
    x, y = np.array([quality.statistics(t or "") for t in rows.text]), rows.quality.to_numpy(float)
    fits = fold != 0
    mean, scale = x[fits].mean(axis=0), x[fits].std(axis=0)
    scale[scale < 1e-9] = 1
    rng = np.random.default_rng(7)
    waves, phases = rng.normal(size=(x.shape[1], quality.FEATURES)) / np.sqrt(x.shape[1] / 2), rng.uniform(0, 2 * np.pi, quality.FEATURES)

    def expand(m):
        return np.hstack([np.sqrt(2 / quality.FEATURES) * np.cos(np.clip((m - mean) / scale, -8, 8) @ waves + phases), np.ones((len(m), 1))])

    z = expand(x[fits & (fold != 1)])
    penalty = np.diag([*[quality.RIDGE * len(z) / quality.FEATURES] * quality.FEATURES, 1e-9])
    weights = np.linalg.solve(z.T @ z + penalty, z.T @ y[fits & (fold != 1)])
    assert np.allclose(model.raw(x), expand(x) @ weights, atol=1e-6)
    held = fits & (fold == 1)
    steps, values = quality.isotonic(expand(x[held]) @ weights, y[held])
    everything = np.array([quality.statistics(t or "") for t in docs.text])
    raw = expand(everything) @ weights
    want = np.clip((1 - quality.TIE_SHARE) * np.interp(raw, steps, values) + quality.TIE_SHARE * np.clip(raw, 0, 1), 0, 1)
    found = {r.doc_id: r.score for r in quality.score(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()}
    assert np.allclose([found[i] for i in docs.doc_id], want, atol=1e-4)


def test_a_bounded_fit_uses_about_that_many_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    n = quality._labelled(docs, labels, "quality", "doc_id", "text", 0, 10**9).count()
    assert n / 8 < quality._labelled(docs, labels, "quality", "doc_id", "text", 0, n // 4).count() < n / 2


def test_isotonic_is_monotone_and_least_squares():
    rng = np.random.default_rng(3)
    x = np.arange(60.0)
    y = (rng.random(60) < x / 60).astype(float)
    ends, values = quality.isotonic(x, y)
    fitted = np.interp(x, ends, values)
    assert (np.diff(values) >= -1e-12).all()
    for _ in range(200):
        other = np.sort(rng.random(60))
        assert ((fitted - y) ** 2).sum() <= ((other - y) ** 2).sum() + 1e-9


def scan(text, table):
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(upper, upper.lower())))
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        own = phrase.split()
        at = [i for i in range(len(words)) if words[i : i + len(own)] == own]
        places += at
        labels |= {label} if at else set()
    found = []
    for i, word in enumerate(words):
        window = " ".join(words[i : i + licenses.WINDOW]) + " "
        for rule in table:
            if rule.keyword.split()[0] == word and (m := re.match(f"{rule.pattern}(?= )", window)):
                found.append((rule.label, rule.priority, i, i + len(m[0].split())))
    kept = [a for a in found if not any(b[2] <= a[2] and b[3] >= a[3] and (b[1] < a[1] or b[1] == a[1] and b[3] - b[2] > a[3] - a[2]) for b in found)]
    return len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels), sorted(kept), sorted(labels | {k[0] for k in kept})


def results(df):
    return [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, sorted(map(tuple, r.spans)), r.labels) for r in df.orderBy("doc_id").collect()]


def test_rules_are_many_and_begin_with_their_keyword():
    table = licenses.rules()
    assert len(table) >= 500 and len(licenses.TEXTS) >= 250 and len({r.priority for r in table}) == 3
    assert all(re.match(re.escape(r.keyword), r.pattern) and re.fullmatch("[a-z0-9]+( [a-z0-9]+){0,3}", r.keyword) for r in table)
    assert all(len(re.sub(r"\(\?:[^()]*\)\?", "", r.pattern).split(" ")) <= licenses.WINDOW for r in table)


# Texts and the labels that they must give, written by hand.
CORPUS = [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", ["mit"]),
    ("SPDX-License-Identifier: Apache-2.0", ["apache-2.0"]),
    ("// SPDX-License-Identifier: Apache-2.0 OR MIT", ["apache-2.0-or-mit"]),
    ("# SPDX-License-Identifier: GPL-2.0-only WITH Linux-syscall-note", ["gpl-2.0-only-with-linux-syscall-note"]),
    ("SPDX-License-Identifier: MIT-0", ["mit-0"]),
    ("Licensed under the Apache License, Version 2.0 (the License)", ["apache-2", "apache-2.0"]),  # the first is a base phrase's
    ("See http://www.apache.org/licenses/LICENSE-2.0 for details", ["apache-2.0"]),
    ("You may get it at https://opensource.org/licenses/MIT.", ["mit"]),
    ("https://creativecommons.org/licenses/by-nc-sa/4.0/", ["cc-by-nc-sa-4.0"]),
    ("GPL version 2 with the Classpath Exception", ["gpl-2.0-with-classpath-exception"]),
    ("As a special exception, if you link this library with other files", ["gcc-exception"]),
    ("This code is not released under MIT license.", ["not-mit"]),
    ("It is incompatible with the GNU GPLv3 here", ["gpl-incompatible"]),
    ("the Software shall be used for Good, not Evil", ["json"]),
    ("The origin of this software must not be misrepresented; altered source versions must be plainly marked as such", ["zlib"]),
    ("GNU General Public License as published by the Free Software Foundation; either version 3 of the License, or (at your option) any later version", ["gpl-3.0-or-later"]),
    ("a plain text with no license words in it", []),
    ("This is a free day, and it is in the park that the software people met", []),
]


def test_labels_of_a_corpus_written_by_hand(spark):
    found = licenses.license_scan(spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CORPUS)], "doc_id long, text string")).orderBy("doc_id").collect()
    assert [(CORPUS[r.doc_id][0], list(r.labels)) for r in found] == CORPUS


def test_base_phrases_are_no_patterns(spark):
    found = licenses.license_scan(spark.createDataFrame([(1, "c++ x"), (2, "ab")], "doc_id long, text string"), base={"a.": "dot"}, table=licenses.rules()[:3]).collect()
    assert all(r.n_base == 0 for r in found)


def test_license_texts(spark):
    texts = [
        "Released under the MIT License, and GNU General Public License v2 or later; cc by nc 4.0 cc by nc", "Apache License, Version 2.0 apache license version 2", "gplv3 lgpl-2.1 bsd-3-clause CC BY-NC-SA 4.0",
        "Permission is hereby granted, free of charge, to any person obtaining a copy", "mit mit license under the mit license under the mit license", "İ Apache-2.0 ﬁ", "licensed under the apache license version 2 0 " * 50, "UNDER THE MIT LICENSEE",
    ]
    table = licenses.rules()
    found = results(licenses.license_scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")))
    assert found == [scan(t, table) for t in texts]


def test_license_query(spark, sf, texts):
    table = licenses.rules()
    found = {r.doc_id: r for r in queries.op5_license_scan(spark, sf).collect()}
    for k, text in texts.items():
        n, places, first, last, base, _, labels = scan(text, table)
        r = found[k]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels) == (n, places, first, last, ",".join(base), ",".join(labels))


def test_license_scan_of_odd_rows_is_native(odd):
    found = licenses.license_scan(odd)
    table = licenses.rules()
    key = lambda r: str(r)
    assert sorted(results(found), key=key) == sorted((scan(t, table) for _, t in ODD), key=key)
    assert licenses.license_scan(odd.limit(0)).count() == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
