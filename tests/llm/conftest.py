from __future__ import annotations

import pytest

SF = "/root/testdata/sf0.001"
#: Columns whose names the operators use for their own.
CLASHING = (
    "n_tokens", "start", "end", "gram", "fp", "key", "n", "set", "rest", "score", "statistics", "labels", "starts", "ends", "kept", "n_bytes", "n_removed", "n_spans", "doc", "rid", "id", "cls", "root", "predicted", "fold", "y",
    "__rid", "__id", "__score", "__own", "__text", "a.b",
)


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def texts(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


ODD = [
    (None, "a null id, under the MIT License"), (1, None), (2, ""), (3, " \t\n "), (4, "repeated row"), (4, "repeated row"), (4, "the same id with another text"), (5, "x" * 3000 + " " + "long text " * 4000),
    (6, "日本語 テキスト é ﬁ <|endoftext|> <s> ▁ \x00 \x85 İ"), (7, "x" * 3000 + " " + "long text " * 4000), (8, "one"), (None, None),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in any column, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame([(i, t, None, None, None, *[None] * len(CLASHING)) for i, t in ODD], schema)
