"""TF-IDF over one- and two-word terms, and its principal components."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import (
    CountVectorizerModel,
    ElementwiseProduct,
    NGram,
    Normalizer,
    RegexTokenizer,
    StopWordsRemover,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame, functions as F

from tickerloom.session import materialize, ship_package, written

TOKEN = r"[\p{L}\p{N}_]{2,}"
HISTOGRAM_ROWS = 1024
FREQUENT_WORDS = 100_000


def terms(df: DataFrame, column: str, stop_words: list[str] | None = None, name: str = "terms") -> DataFrame:
    """Adds the lower-case words without stop words, and their neighbouring pairs."""
    words = RegexTokenizer(inputCol="_text", outputCol="_words", pattern=TOKEN, gaps=False, toLowercase=True)
    stops = stop_words if stop_words is not None else StopWordsRemover.loadDefaultStopWords("english")
    kept = StopWordsRemover(inputCol="_words", outputCol="_kept", stopWords=stops)
    pairs = NGram(n=2, inputCol="_kept", outputCol="_pairs")
    tokenized = kept.transform(words.transform(df.withColumn("_text", F.coalesce(F.col(column), F.lit("")))))
    return (
        pairs.transform(tokenized)
        .withColumn(name, F.concat("_kept", "_pairs"))
        .drop("_text", "_words", "_kept", "_pairs")
    )


@lru_cache(maxsize=1)
def _word_characters() -> np.ndarray:
    """Every character that `TOKEN` takes, by code point."""
    import regex

    taken = np.zeros(sys.maxunicode + 1, dtype=bool)
    every = "".join(chr(code) for code in range(len(taken)) if not 0xD800 <= code < 0xE000)
    taken[np.frombuffer("".join(regex.findall(TOKEN.removesuffix("{2,}"), every)).encode("utf-32-le"), dtype="<u4")] = True
    return taken


def _kept_words(texts: list[str | None], dropped: frozenset[str]) -> list[str]:
    """The words of every text joined by blanks, all texts split in one pass over their characters."""
    lowered = [(text or "").lower() for text in texts]
    codes = np.frombuffer("\n".join(lowered).encode("utf-32-le"), dtype="<u4")
    ends = np.cumsum([len(text) + 1 for text in lowered])[:-1] - 1
    spaced = np.where(_word_characters()[codes], codes, 32).astype("<u4")
    spaced[ends] = 10
    rows = spaced.tobytes().decode("utf-32-le").split("\n")
    return [" ".join([word for word in row.split(" ") if len(word) > 1 and word not in dropped]) for row in rows]


def histograms(df: DataFrame, column: str, key: str, stop_words: list[str] | None = None) -> DataFrame:
    """The key of every row with the words that count, in order and joined by blanks (`words`), stored.

    Words are those of `terms`. A row's histogram, of its words and of their neighbouring pairs, is taken from
    this column on numbers, a batch at a time (`_numbered`): texts are split once for the vocabulary and the
    weights, and no (row, term) rows are stored or shuffled.
    """
    stops = list(stop_words if stop_words is not None else StopWordsRemover.loadDefaultStopWords("english"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dropped = frozenset(stops)
        for batch in batches:
            for at in range(0, batch.num_rows, HISTOGRAM_ROWS):
                part = batch.slice(at, HISTOGRAM_ROWS)
                found = _kept_words(part.column(1).to_pylist(), dropped)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string())], names=[key, "words"])

    ship_package(df.sparkSession)
    narrow = df.select(key, F.col(column).cast("string").alias("_text"))
    return written(narrow.mapInArrow(run, f"`{key}` {dict(df.dtypes)[key]}, words string"), "histograms")


def _numbered(words: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of rows of `histograms`, and number and row of every word in order."""
    lists = pc.split_pattern(words, " ")
    rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    coded = lists.flatten().dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    # A row without words is split into one empty word.
    filled = pc.not_equal(coded.dictionary, "").to_numpy(zero_copy_only=False)[codes] if len(codes) else np.zeros(0, dtype=bool)
    return coded.dictionary, codes[filled], rows[filled]


def _pairs(codes: np.ndarray, rows: np.ndarray, many: int) -> tuple[np.ndarray, np.ndarray]:
    """Number (first * many + second) and row of neighbouring words; words numbered below 0 are in no pair."""
    both = (rows[:-1] == rows[1:]) & (codes[:-1] >= 0) & (codes[1:] >= 0)
    return (codes[:-1] * many + codes[1:])[both], rows[:-1][both]


def _sums(numbers: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct numbers, how often each occurs and in how many rows."""
    some = int(rows.max(initial=0)) + 1
    pairs, counts = np.unique(numbers * some + rows, return_counts=True)
    found, starts = np.unique(pairs // some, return_index=True)
    occurrences = np.add.reduceat(counts, starts) if len(found) else counts
    return found, occurrences, np.diff(np.append(starts, len(pairs)))


def _totals(counted: DataFrame, min_documents: int, frequent: list[str] | None = None, pairs: bool = False) -> DataFrame:
    """Occurrences and documents of the words, or of the pairs (of the frequent words, if given)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if frequent is None else pa.array(frequent, pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, HISTOGRAM_ROWS):
                names, codes, rows = _numbered(batch.column(0).slice(at, HISTOGRAM_ROWS))
                if known is not None:
                    codes = pc.index_in(names, value_set=known).fill_null(-1).to_numpy().astype(np.int64)[codes]
                    names = known
                if pairs:
                    codes, rows = _pairs(codes, rows, len(names))
                found, occurrences, documents = _sums(codes, rows)
                if pairs:
                    first, second = (names.take(pa.array(part)) for part in (found // max(len(names), 1), found % max(len(names), 1)))
                    found_names = pc.binary_join_element_wise(first, second, " ")
                else:
                    found_names = names.take(pa.array(found))
                yield pa.RecordBatch.from_arrays(
                    [found_names, pa.array(occurrences, pa.int64()), pa.array(documents, pa.int64())],
                    names=["term", "occurrences", "documents"],
                )

    parts = counted.select("words").mapInArrow(run, "term string, occurrences long, documents long")
    sums = parts.groupBy("term").agg(F.sum("occurrences").alias("occurrences"), F.sum("documents").alias("documents"))
    return sums.where(F.col("documents") >= min_documents)


def vocabulary(counted: DataFrame, max_features: int = 1000, min_documents: int = 2) -> DataFrame:
    """The most frequent terms found in enough documents, with their document counts.

    A pair occurs no more often, and in no more documents, than either of its words. So single words are
    counted first, and then only pairs of words as frequent as the last word that would be chosen: the many
    pairs that occur once or twice are not counted, and no chosen term is lost. Where so many words are
    equally frequent that a task should not hold them (`FREQUENT_WORDS`), all pairs are counted.
    """
    ship_package(counted.sparkSession)

    def first(found: DataFrame) -> DataFrame:
        return found.orderBy(F.desc("occurrences"), "term").limit(max_features)

    words = written(_totals(counted, min_documents), "words")
    least, chosen = first(words).agg(F.min("occurrences"), F.count("*")).first()
    able = words if chosen < max_features else words.where(F.col("occurrences") >= least)
    frequent = [row["term"] for row in able.select("term").limit(FREQUENT_WORDS + 1).collect()]
    pairs = _totals(counted, min_documents, frequent if len(frequent) <= FREQUENT_WORDS else None, pairs=True)
    return first(words.unionByName(pairs))


def _places(words: pa.Array, terms: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in `terms` and count of every term of rows of `histograms` that is among them, by row and place."""
    names, codes, rows = _numbered(words)
    parts = pa.array(sorted({word for term in terms for word in term.split(" ")}), pa.string())
    codes = pc.index_in(names, value_set=parts).fill_null(-1).to_numpy().astype(np.int64)[codes]
    number = {word: at for at, word in enumerate(parts.to_pylist())}
    many = len(parts)
    # Words are numbered from 0, pairs from `many` on.
    wanted = []
    for term in terms:
        word, _, second = term.partition(" ")
        wanted.append(many + number[word] * many + number[second] if second else number[word])
    order = np.argsort(wanted)
    sorted_terms = np.array(wanted, dtype=np.int64)[order]
    double, double_rows = _pairs(codes, rows, many)
    numbers, rows = np.concatenate([codes, double + many]), np.concatenate([rows, double_rows])
    at = np.minimum(np.searchsorted(sorted_terms, numbers), max(len(terms) - 1, 0))
    found = sorted_terms[at] == numbers if terms else np.zeros(len(numbers), dtype=bool)
    keys, counts = np.unique(rows[found] * max(len(terms), 1) + order[at[found]], return_counts=True)
    return keys // max(len(terms), 1), keys % max(len(terms), 1), counts


class TfIdf:
    """Fitted vocabulary and weights; `transform` is plain pipeline stages.

    The vocabulary on the driver has at most `max_features` terms.
    """

    def __init__(self, terms: list[str], documents: list[int], rows: int, stop_words: list[str] | None):
        self.terms = terms
        self.weights = [math.log((1 + rows) / (1 + count)) + 1 for count in documents]
        self.stop_words = stop_words

    def transform(self, df: DataFrame, column: str, name: str = "tfidf", counted: DataFrame | None = None) -> DataFrame:
        """`df` with its vectors, or, given its `histograms`, their keys with the vectors: no text is split again."""
        counts = CountVectorizerModel.from_vocabulary(self.terms, inputCol="terms", outputCol="_counts")
        weighted = ElementwiseProduct(inputCol="_counts", outputCol="_weighted", scalingVec=Vectors.dense(self.weights))
        unit = Normalizer(p=2.0, inputCol="_weighted", outputCol=name)
        found = terms(df, column, self.stop_words) if counted is None else self._repeated(counted)
        return unit.transform(weighted.transform(counts.transform(found))).drop("terms", "_counts", "_weighted")

    def _repeated(self, counted: DataFrame) -> DataFrame:
        """The terms of every histogram that are in the vocabulary, as often as they occur."""
        names = self.terms
        key = counted.columns[0]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = pa.array(names, pa.string())
            for batch in batches:
                for at in range(0, batch.num_rows, HISTOGRAM_ROWS):
                    part = batch.slice(at, HISTOGRAM_ROWS)
                    rows, places, counts = _places(part.column(1), names)
                    sizes = np.bincount(rows, counts, minlength=part.num_rows).astype(np.int64)
                    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                    lists = pa.ListArray.from_arrays(offsets, known.take(pa.array(np.repeat(places, counts))))
                    yield pa.RecordBatch.from_arrays([part.column(0), lists], names=[key, "terms"])

        ship_package(counted.sparkSession)
        return counted.mapInArrow(run, f"`{key}` {dict(counted.dtypes)[key]}, terms array<string>")


def fit_tfidf(
    df: DataFrame,
    column: str,
    key: str,
    max_features: int = 1000,
    min_documents: int = 2,
    stop_words: list[str] | None = None,
    counted: DataFrame | None = None,
) -> TfIdf:
    """`counted` takes the table of `histograms` if there is one already."""
    counted = counted if counted is not None else histograms(df, column, key, stop_words)
    chosen = vocabulary(counted, max_features, min_documents).collect()
    chosen.sort(key=lambda row: row["term"])
    return TfIdf([r["term"] for r in chosen], [r["documents"] for r in chosen], counted.count(), stop_words)


def tfidf_weights(df: DataFrame, model: TfIdf, column: str, key: str, counted: DataFrame | None = None) -> DataFrame:
    """Non-zero weights as rows (key, term, weight), a document per row of `df`.

    A row's histogram meets the vocabulary (at most `max_features` terms) in its task, so nothing is shuffled.
    """
    counted = counted if counted is not None else histograms(df, column, key, model.stop_words)
    names, idf = model.terms, model.weights
    ship_package(counted.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, scale = pa.array(names, pa.string()), np.array(idf, dtype=float)
        for batch in batches:
            for at in range(0, batch.num_rows, HISTOGRAM_ROWS):
                part = batch.slice(at, HISTOGRAM_ROWS)
                rows, places, counts = _places(part.column(1), names)
                x = counts * scale[places]
                length = np.sqrt(np.bincount(rows, x * x, minlength=part.num_rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows)), known.take(pa.array(places)), pa.array(x / length[rows])],
                    names=[key, "term", "weight"],
                )

    return counted.mapInArrow(run, f"`{key}` {dict(counted.dtypes)[key]}, term string, weight double")


def _second_moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a task's sum of (1, x) times its transpose."""
    total = None
    for batch in batches:
        for at in range(0, batch.num_rows, HISTOGRAM_ROWS):
            lists = batch.column(0).slice(at, HISTOGRAM_ROWS)
            x = np.column_stack([np.ones(len(lists)), lists.flatten().to_numpy().reshape(len(lists), -1)])
            total = x.T @ x if total is None else total + x.T @ x
    if total is not None:
        yield from _matrix_rows(dict(enumerate(total)))


def _summed_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, values in zip(batch.column(0).to_pylist(), batch.column(1)):
            sums[at] = sums.get(at, 0) + values.values.to_numpy()
    if sums:
        yield from _matrix_rows(sums)


def _matrix_rows(rows: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for at, values in rows.items():
        yield pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([values], pa.list_(pa.float64()))], names=["at", "values"])


def _principal(vectors: DataFrame, k: int, column: str) -> tuple[np.ndarray, np.ndarray]:
    """The first k principal directions, and the mean's coordinates on them.

    Tasks multiply batches by themselves; the rows of their products are summed side by side.
    """
    schema = "at int, values array<double>"
    products = vectors.select(vector_to_array(column)).mapInArrow(_second_moments, schema)
    rows = products.repartition("at").mapInArrow(_summed_rows, schema).collect()
    moments = np.array([row["values"] for row in sorted(rows, key=lambda row: row["at"])])
    n, mean = moments[0, 0], moments[0, 1:] / moments[0, 0]
    covariance = (moments[1:, 1:] - n * np.outer(mean, mean)) / max(n - 1, 1)
    directions = np.linalg.eigh(covariance)[1][:, ::-1][:, :k]
    return directions, mean @ directions


def with_components(vectors: DataFrame, model: TfIdf, components: int = 50, column: str = "tfidf") -> DataFrame:
    """Adds centred principal components `tfidf_pca_<i>`; their signs are arbitrary.

    The vectors are read twice, so they are stored first. The driver holds a matrix of the vocabulary's size.
    """
    ship_package(vectors.sparkSession)
    vectors = materialize(vectors)
    k = min(components, len(model.terms))
    if k == 0 or vectors.isEmpty():
        return vectors.withColumns({f"tfidf_pca_{i}": F.lit(None).cast("double") for i in range(k)})
    directions, centre = _principal(vectors, k, column)

    @F.pandas_udf("array<double>")
    def project(x: pd.Series) -> pd.Series:
        return pd.Series(list(np.stack(x.to_numpy()) @ directions - centre)) if len(x) else x

    values = vectors.withColumn("_values", project(vector_to_array(column)))
    return values.withColumns({f"tfidf_pca_{i}": F.get("_values", F.lit(i)) for i in range(k)}).drop("_values")
