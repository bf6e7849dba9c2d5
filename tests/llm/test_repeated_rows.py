"""Rows that repeat each other in full, many times, beside texts that share passages with them."""

from __future__ import annotations

import random
import time

from pyspark.sql import functions as F

from isobar.llm import suffix


def _table(spark, n: int):
    rng = random.Random(4)
    passages = ["".join(rng.choice("abcdefgh ") for _ in range(150)) for _ in range(3)]

    def beside(k: int) -> str:
        return "".join("".join(rng.choice("ijklmnop") for _ in range(40)) + p for p in passages)

    first, second = beside(1), beside(2)
    return spark.range(n).select(F.lit(7).cast("long").alias("doc_id"), F.lit(first).alias("text")).unionByName(spark.createDataFrame([(8, second)], "doc_id long, text string")), first, second


def test_a_hundred_thousand_equal_rows(spark):
    took = {}
    for n in (10_000, 100_000):
        df, first, second = _table(spark, n)
        began = time.time()
        found = suffix.remove_repeats(df, threshold=200, outputs=("kept",)).groupBy("doc_id", "n_bytes", "n_removed", "n_spans", "kept").count().collect()
        took[n] = time.time() - began
        assert {tuple(r) for r in found} == {(7, len(first), len(first), 1, "", n), (8, len(second), 0, 0, second, 1)}
    assert took[100_000] < 12 * max(took[10_000], 5), took


def test_equal_rows_that_share_windows_with_another_text(spark):
    rng = random.Random(5)
    shared = "".join(rng.choice("abcdefgh ") for _ in range(230))
    other = "x" * 90 + shared + "y" * 90
    df = spark.createDataFrame([(1, "p" * 20 + shared + "q" * 30)] * 300 + [(2, other)], "doc_id long, text string").repartition(5)
    found = suffix.remove_repeats(df, threshold=200, outputs=("kept",)).groupBy("doc_id", "n_removed", "n_spans", "kept").count().collect()
    assert {tuple(r) for r in found} == {(1, 280, 1, "", 300), (2, 230, 1, "x" * 90 + "y" * 90, 1)}
