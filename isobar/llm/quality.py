"""Quality classifier: random Fourier features of document statistics, ridge scores, isotonic calibration.

A text becomes a few statistics (``STATISTICS``), standardised over the
training rows. ``FEATURES`` random cosines of them approximate a Gaussian
kernel. Each task sums the normal equations of its rows; the sums are added
and solved once. Scores of rows that the ridge has not seen are calibrated by
isotonic regression.

The fit uses at most about ``MAX_ROWS`` labelled rows, taken by a hash of the
id if there are more; only these are described for it. Everything else covers
all rows, in one pass. Without any labelled row every score is 0.5.

A null text counts as empty; empty texts have statistics (zeros) and a score
like any other. Labels that are null are ignored; an id with several labels
counts by their mean, and of several texts under it the least fits. Null ids have no label and are held out by no fold. An
empty table gives an empty result. Labels, languages, sources and ids are
never inputs of a score.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from isobar.llm.common import checkpointed, map_texts, text_or_empty, whole_rows

FEATURES = 256
RIDGE = 1e-3
MAX_ROWS = 200_000
FIT_TASKS = 8
#: The part of a score that keeps the order within a calibration step.
TIE_SHARE = 0.02
SYMBOLS = b"#$%&*@=~^<>{}[]\\_+|/"

STATISTICS = (
    "log_bytes", "log_words", "word_length", "upper", "digit", "space", "stop", "comma", "exclaimed", "symbol", "pipe", "non_ascii", "entropy",
    "distinct_words", "top_word", "distinct_pairs", "repeated_lines", "log_line", "bare_words", "ends_in_symbol",
)


def statistics(text: str) -> list[float]:
    data = text.encode()
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    share = counts[counts > 0] / n
    words = data.split()
    m = max(1, len(words))
    letters = max(1, counts[65:91].sum() + counts[97:123].sum())
    lines = [line for line in data.split(b"\n") if line]
    top = max(Counter(words).values(), default=0)
    distinct = len(set(words))
    pairs = len(set(zip(words, words[1:], strict=False)))
    values = [
        np.log1p(n), np.log1p(len(words)), (n - counts[32]) / m, counts[65:91].sum() / letters, counts[48:58].sum() / n, (counts[32] + counts[9:14].sum()) / n, counts[46] / m, counts[44] / m,
        counts[33] / m, sum(counts[b] for b in SYMBOLS) / n, counts[124] / m, counts[128:].sum() / n, float(-(share * np.log2(share)).sum()),
        np.log1p(distinct) / np.log1p(m), top / m, pairs / max(1, len(words) - 1), 1 - len(set(lines)) / max(1, len(lines)), np.log1p(n / max(1, len(lines))),
        sum(1 for w in words if not w.isalpha() and w.isascii() and not any(65 <= b <= 90 or 97 <= b <= 122 for b in w)) / m, sum(1 for w in words if w[-1] in SYMBOLS or w[-1] == 33) / m,
    ]
    return list(map(float, values))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    waves: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    steps: np.ndarray
    values: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _expanded(x, self.mean, self.scale, self.waves, self.phases) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        calibrated = np.interp(raw, self.steps, self.values) if len(self.steps) else np.full(len(raw), 0.5)
        return np.clip((1 - TIE_SHARE) * calibrated + TIE_SHARE * np.clip(raw, 0, 1), 0, 1)


def _expanded(x: np.ndarray, mean: np.ndarray, scale: np.ndarray, waves: np.ndarray, phases: np.ndarray) -> np.ndarray:
    z = np.clip((x - mean) / scale, -8, 8)
    return np.hstack([np.sqrt(2 / waves.shape[1]) * np.cos(z @ waves + phases), np.ones((len(x), 1))])


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool-adjacent-violators: ends and values of the steps of the best non-decreasing fit; between steps it is linear."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []
    for a, b in zip(x[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([a, a, b, 1.0])
        while len(blocks) > 1 and blocks[-2][2] >= blocks[-1][2]:
            _, end, b2, n2 = blocks.pop()
            start, _, b1, n1 = blocks.pop()
            blocks.append([start, end, (b1 * n1 + b2 * n2) / (n1 + n2), n1 + n2])
    return np.array([e for b in blocks for e in b[:2]]), np.array([b[2] for b in blocks for _ in range(2)])


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % 5


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, len(STATISTICS))


def _labelled(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str, held_out: int | None, max_rows: int) -> DataFrame:
    """statistics, y and fold of about ``max_rows`` labelled rows at most, those of fold ``held_out`` left out."""
    id_ = F.col(f"`{id_col}`")
    truth = labels.where(F.col(label_col).isNotNull() & id_.isNotNull()).groupBy(id_.alias("id")).agg(F.avg(F.col(label_col).cast("double")).alias("y")).withColumn("fold", fold("id"))
    if held_out is not None:
        truth = truth.where(F.col("fold") != held_out)
    truth = checkpointed(truth)
    n = truth.count()
    if n > max_rows:
        truth = truth.where(F.shiftrightunsigned(F.xxhash64("id"), 1) <= int(max_rows / n * (2**63 - 1024)))
    # max_rows ids or so: small whatever the corpus, so the texts stay where they are.
    texts = docs.select(id_.alias("id"), text_or_empty(f"`{text_col}`").alias("text")).join(F.broadcast(truth), "id")
    texts = texts.groupBy("id").agg(F.min("text").alias("text"), F.first("y").alias("y"), F.first("fold").alias("fold"))

    def start():
        return lambda texts: [[statistics(text) for text in texts]]

    return checkpointed(map_texts(texts, ["y", "fold"], F.col("text"), start, [T.StructField("statistics", T.ArrayType(T.DoubleType()))]))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text", held_out: int | None = 0, calibration: int = 1, max_rows: int = MAX_ROWS, seed: int = 7) -> Model:
    """Fits on the rows of ``docs`` that have a label and are not of fold ``held_out``.

    Rows of fold ``calibration`` calibrate, the others fit the ridge.
    """
    rows = _labelled(docs, labels, label_col, id_col, text_col, held_out, max_rows)
    n = rows.count()
    width = len(STATISTICS)
    rng = np.random.default_rng(seed)
    waves, phases = rng.normal(size=(width, FEATURES)) / np.sqrt(width / 2), rng.uniform(0, 2 * np.pi, FEATURES)
    if not n:
        return Model(np.zeros(width), np.ones(width), waves, phases, np.zeros(FEATURES + 1), np.empty(0), np.empty(0))
    moments = rows.agg(*[f(F.col("statistics")[i]).alias(f"{k}{i}") for i in range(width) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    mean = np.array([moments[f"m{i}"] for i in range(width)])
    scale = np.array([moments[f"s{i}"] for i in range(width)])
    scale[scale < 1e-9] = 1.0

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram, moment = np.zeros((FEATURES + 1, FEATURES + 1)), np.zeros(FEATURES + 1)
        for batch in batches:
            z, y = _expanded(_matrix(batch.column(0)), mean, scale, waves, phases), np.asarray(batch.column(1))
            gram += z.T @ z
            moment += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([moment.tobytes()])], names=["gram", "moment"])

    ridge = rows.where(F.col("fold") != calibration)
    parts = (ridge if not ridge.isEmpty() else rows).select("statistics", "y").coalesce(FIT_TASKS).mapInArrow(sums, "gram binary, moment binary").collect()
    gram = sum(np.frombuffer(p.gram).reshape(FEATURES + 1, -1) for p in parts)
    moment = sum(np.frombuffer(p.moment) for p in parts)
    total = max(1.0, gram[-1, -1])
    penalty = np.full(FEATURES + 1, RIDGE * total / FEATURES)
    penalty[-1] = 1e-9
    weights = np.linalg.solve(gram + np.diag(penalty), moment)
    model = Model(mean, scale, waves, phases, weights, np.empty(0), np.empty(0))
    held = rows.where(F.col("fold") == calibration)
    seen = (held if not held.isEmpty() else rows).select("statistics", "y").toArrow()
    model.steps, model.values = isotonic(model.raw(_matrix(seen.column(0).combine_chunks())), np.asarray(seen.column(1)))
    return model


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """``keep``, score (0 to 1) and predicted (1 if score >= threshold) of every row."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def start():
        def judge(texts: list[str]) -> list:
            x = np.array([statistics(text) for text in texts], dtype=float).reshape(-1, len(STATISTICS))
            return [(sent.value.score(x) if len(x) else np.empty(0)).tolist()]

        return judge

    scored = map_texts(docs, keep, text_or_empty(f"`{text_col}`"), start, [T.StructField("score", T.DoubleType())])
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without those that the classifier rejects; all columns as they are, whatever their names."""
    model = fit(docs, labels, id_col=id_col, text_col=text_col)
    return score(whole_rows(docs, id_col, text_col), model, ("doc",), threshold).where("predicted = 1").select("doc.*")
