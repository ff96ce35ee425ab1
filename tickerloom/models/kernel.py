"""Nyström features: the RBF kernel of any number of rows by way of a few landmark rows.

A linear model on the features has the kernel's decision function, with the kernel replaced by its best
approximation on the span of the landmarks. Fitting takes two scans of narrow aggregates (how many distinct
rows there are, then a hash sample of them); the rows themselves are transformed where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, DoubleType

from tickerloom.session import ship_package

# Candidates drawn per landmark; directions whose share of the largest eigenvalue is rounding are left out.
CANDIDATES = 4
ROUNDING = 1e-10


def rbf(x: np.ndarray, y: np.ndarray, gamma: float) -> np.ndarray:
    """exp(-gamma |x - y|^2) of every row of x with every row of y."""
    square = (x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2 * (x @ y.T)
    return np.exp(-gamma * np.maximum(square, 0))


def leverages(block: np.ndarray, ridge: float) -> np.ndarray:
    """Ridge leverage scores: the diagonal of K (K + ridge I)^-1, how much each row adds that others do not."""
    values, vectors = np.linalg.eigh(block)
    values = np.maximum(values, 0)
    return (vectors * vectors) @ (values / (values + ridge))


def choose_landmarks(pool: np.ndarray, size: int, gamma: float, seed: int) -> np.ndarray:
    """At most `size` rows of the pool, drawn without replacement in proportion to their leverage."""
    if len(pool) <= size:
        return pool
    score = leverages(rbf(pool, pool, gamma), len(pool) / size)
    # The largest of log weight plus Gumbel noise are a weighted draw without replacement.
    noise = -np.log(-np.log(np.random.default_rng(seed).uniform(size=len(pool))))
    return pool[np.sort(np.argsort(-(np.log(np.maximum(score, 1e-300)) + noise))[:size])]


def whitening(landmarks: np.ndarray, gamma: float) -> np.ndarray:
    """W with W W' the pseudo-inverse of the landmarks' kernel block: k(x, landmarks) W are x's features."""
    values, vectors = np.linalg.eigh(rbf(landmarks, landmarks, gamma))
    kept = values > ROUNDING * values[-1]
    return vectors[:, kept] / np.sqrt(values[kept])


class _Kernel(HasInputCol, HasOutputCol):
    gamma = Param(Params._dummy(), "gamma", "kernel width; 0 for 1/inputs", TypeConverters.toFloat)

    def width(self, inputs: int) -> float:
        return self.getOrDefault("gamma") or 1.0 / max(inputs, 1)


class NystroemModel(Model, _Kernel, DefaultParamsReadable, DefaultParamsWritable):
    """Landmarks are a parameter (at most the number asked for, one after the other), so the model is stored as any other."""

    landmarks = Param(Params._dummy(), "landmarks", "landmark rows, end to end", TypeConverters.toListFloat)
    inputs = Param(Params._dummy(), "inputs", "values per landmark", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=0.0, landmarks=None, inputs=None):
        super().__init__()
        self._setDefault(gamma=0.0)
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        ship_package(df.sparkSession)
        inputs = self.getOrDefault("inputs")
        places = np.array(self.getOrDefault("landmarks")).reshape(-1, inputs)
        gamma = self.width(inputs)
        white = whitening(places, gamma)

        @F.pandas_udf(ArrayType(DoubleType()))
        def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for rows in batches:
                if rows.empty:
                    yield rows
                else:
                    yield pd.Series(list(rbf(np.stack(rows.to_numpy()), places, gamma) @ white))

        return df.withColumn(self.getOutputCol(), array_to_vector(features(vector_to_array(self.getInputCol()))))


class Nystroem(Estimator, _Kernel, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Draws the landmarks by their leverage from a hash sample of the distinct rows.

    The sample holds some CANDIDATES * `landmarks` rows whatever the number of rows: a row is in it by
    its own values' hash, below a share that follows from the number of distinct rows. Copies are one
    candidate, so a row that a third of the table repeats is one landmark at most.
    """

    landmarks = Param(Params._dummy(), "landmarks", "number of landmark rows", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, gamma=0.0, landmarks=256, seed=42):
        super().__init__()
        self._setDefault(gamma=0.0, landmarks=256, seed=42)
        self._set(**{name: value for name, value in self._input_kwargs.items() if value is not None})

    def _fit(self, df: DataFrame) -> NystroemModel:
        size, seed = self.getOrDefault("landmarks"), self.getOrDefault("seed")
        rows = df.select(vector_to_array(self.getInputCol()).alias("x")).withColumn("at", F.xxhash64(F.lit(seed), "x"))
        distinct = rows.agg(F.approx_count_distinct("at", 0.02)).first()[0]
        share = CANDIDATES * size / max(distinct, 1)
        sample = rows if share >= 0.9 else rows.where(F.pmod("at", F.lit(1 << 30)) < int(share * (1 << 30)))
        # Sorted, so that the draw does not depend on the order in which tasks end.
        found = sorted(tuple(row["x"]) for row in sample.select("x").distinct().collect())
        if not found:
            raise ValueError("no rows to draw landmarks from")
        pool = np.array(found, dtype=float)
        gamma = self.width(pool.shape[1])
        chosen = choose_landmarks(pool, size, gamma, seed)
        return NystroemModel(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), gamma=gamma,
            landmarks=chosen.ravel().tolist(), inputs=pool.shape[1],
        )
