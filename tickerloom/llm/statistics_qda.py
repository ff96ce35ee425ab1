"""Quality classifier: a regularised quadratic discriminant over transformed document statistics.

Class means and covariances come from one aggregate over all labelled documents (counts, sums, products), so
nothing is sampled. Each covariance is shrunk towards the pooled one and a diagonal; its
Cholesky factor is computed once and sent to the tasks, which score numpy batches: the score is
the logistic of the difference of the Mahalanobis log densities plus log priors, over a
temperature fitted on the training rows' statistics.

Defined cases: null text is empty text; every row is scored; labels of 0 and 1 in the
training rows are both needed, otherwise the score is the share of ones (0.5 without any label).
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickerloom.llm.common import is_held_out, labels_by_document, ship, stored

FEATURES = (
    "words", "word_length", "symbols", "letters", "digits", "upper", "bars", "ended_lines",
    "line_words", "distinct", "repeat_runs", "dup_lines", "common", "packed",
)
BATCH_ROWS = 256
SHRINK_TO_POOLED = 0.3
SHRINK_TO_DIAGONAL = 0.1
FLOOR = 1e-3
TEMPERATURE = 2.0
SYMBOLS = re.compile(r"[#*$%&|<>~^_=\\{}\[\]@]")
ENDED = re.compile(r"[.!?…:;\"”»)]\s*$")


def logit(share: float) -> float:
    return float(np.log((share + 0.002) / (1.002 - share)))


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text, in the order of FEATURES."""
    words = text.split()
    n = max(1, len(words))
    solid = max(1, sum(map(len, words)))
    lines = [line for line in text.split("\n") if line.strip()]
    n_lines = max(1, len(lines))
    letters = len(re.sub(r"[\W\d_]+", "", text))
    symbols = len(SYMBOLS.findall(text))
    digits = len(re.findall(r"[0-9]", text))
    upper = len(re.findall(r"[A-Z]", text))
    same = sum(a == b for a, b in zip(words, words[1:]))
    counts: dict[str, int] = {}
    for word in words:
        counts[word] = counts.get(word, 0) + 1
    raw = text.encode()
    packed = sum(len(zlib.compress(raw[i : i + 32768], 1)) for i in range(0, len(raw), 32768)) / max(1, len(raw))
    return [
        float(np.log1p(len(words))),
        float(np.log(solid / n)),
        logit(min(1.0, symbols / solid)),
        logit(min(1.0, letters / solid)),
        logit(min(1.0, digits / solid)),
        logit(min(1.0, upper / solid)),
        logit(min(1.0, text.count("|") / n)),
        logit(sum(bool(ENDED.search(line)) for line in lines) / n_lines),
        float(np.log1p(len(words) / n_lines)),
        logit(len(counts) / n),
        logit(same / n),
        logit(1 - len(set(lines)) / n_lines),
        logit(max(counts.values(), default=0) / n),
        packed,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """doc_id and `stats`, an array of doubles."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                values = [statistics(t or "") for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "stats"]
                )

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, "doc_id long, stats array<double>")


class Discriminant:
    """Class densities with cached Cholesky factors of the precisions."""

    def __init__(self, counts: np.ndarray, sums: np.ndarray, products: np.ndarray):
        self.share = counts[1] / counts.sum() if counts.sum() else 0.5
        self.ready = bool((counts >= 2).all())
        if not self.ready:
            return
        size = sums.shape[1]
        self.means = sums / counts[:, None]
        scatters = products - counts[:, None, None] * self.means[:, :, None] * self.means[:, None, :]
        pooled = scatters.sum(axis=0) / max(1.0, counts.sum() - 2)
        self.factors, self.offsets = [], []
        for k in range(2):
            own = scatters[k] / max(1.0, counts[k] - 1)
            mixed = (1 - SHRINK_TO_POOLED) * own + SHRINK_TO_POOLED * pooled
            shrunk = (1 - SHRINK_TO_DIAGONAL) * mixed + SHRINK_TO_DIAGONAL * np.diag(np.diag(mixed)) + FLOOR * np.eye(size)
            root = np.linalg.cholesky(shrunk)
            self.factors.append(np.linalg.inv(root).T)
            self.offsets.append(np.log(counts[k] / counts.sum()) - np.log(np.diag(root)).sum())

    def scores(self, values: np.ndarray) -> np.ndarray:
        if not self.ready or not len(values):
            return np.full(len(values), self.share)
        density = [
            offset - 0.5 * (((values - mean) @ factor) ** 2).sum(axis=1)
            for mean, factor, offset in zip(self.means, self.factors, self.offsets)
        ]
        return 1 / (1 + np.exp(-np.clip((density[1] - density[0]) / TEMPERATURE, -60, 60)))


def fit(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """Moments per class over all labelled rows of `stats`, in one aggregate."""
    size = len(FEATURES)
    pairs = [(i, j) for i in range(size) for j in range(i, size)]
    value = lambda i: F.get(F.col("stats"), i)
    moments = [F.count("*").alias("n")]
    moments += [F.sum(value(i)).alias(f"s{i}") for i in range(size)]
    moments += [F.sum(value(i) * value(j)).alias(f"p{i}_{j}") for i, j in pairs]
    counts, sums, products = np.zeros(2), np.zeros((2, size)), np.zeros((2, size, size))
    for row in stats.join(labels, "doc_id").groupBy("label").agg(*moments).collect():
        k = row["label"]
        counts[k] = row["n"]
        sums[k] = [row[f"s{i}"] for i in range(size)]
        for i, j in pairs:
            products[k, i, j] = products[k, j, i] = row[f"p{i}_{j}"]
    return Discriminant(counts, sums, products)


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted per row; labels of held-out documents are never used."""
    stats = stored(document_statistics(docs), "statistics")
    training = labels_by_document(labels, "quality").where(~is_held_out(F.col("doc_id")))
    model = fit(stats, training)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.array(batch.column(1).to_pylist(), dtype=float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(values))], names=["doc_id", "score"])

    scored = stats.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
