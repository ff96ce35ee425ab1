"""Model registry: named Spark ML estimators with defaults and search spaces."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    MultilayerPerceptronClassifier,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler

from tickerloom.models.kernel import Nystroem

FEATURES = "features"


# An estimator factory gets parameters, the row count, the feature count and the columns to write.
Build = Callable[[Mapping[str, Any], "Frame"], Estimator]


@dataclass(frozen=True)
class Frame:
    """What an estimator needs to know of its training table."""

    label: str
    rows: int
    features: int
    weight: str | None
    prefix: str
    validation: str | None = None

    def outputs(self) -> dict[str, str]:
        return {
            "featuresCol": FEATURES,
            "labelCol": self.label,
            "predictionCol": f"{self.prefix}_prediction",
            "probabilityCol": f"{self.prefix}_probability",
            "rawPredictionCol": f"{self.prefix}_raw",
        }

    def weights(self) -> dict[str, str]:
        return {"weightCol": self.weight} if self.weight else {}


@dataclass(frozen=True)
class Model:
    name: str
    defaults: Mapping[str, Any]
    build: Build
    space: Mapping[str, Callable[[random.Random], Any]] = field(default_factory=dict)


def _logistic(params: Mapping[str, Any], frame: Frame) -> Estimator:
    # C weighs the summed loss, Spark's regParam the mean loss.
    return LogisticRegression(
        regParam=1 / (params["C"] * frame.rows),
        elasticNetParam=params["l1_ratio"],
        maxIter=params["max_iter"],
        standardization=True,
        **frame.outputs(),
        **frame.weights(),
    )


def _forest(params: Mapping[str, Any], frame: Frame) -> Estimator:
    return RandomForestClassifier(
        numTrees=params["n_estimators"],
        maxDepth=params["max_depth"],
        minInstancesPerNode=params["min_samples_leaf"],
        featureSubsetStrategy=params["max_features"],
        seed=params["seed"],
        **frame.outputs(),
        **frame.weights(),
    )


def _boosted(params: Mapping[str, Any], frame: Frame) -> Estimator:
    trees = GBTClassifier(
        maxIter=params["n_estimators"],
        maxDepth=params["max_depth"],
        stepSize=params["learning_rate"],
        subsamplingRate=params["subsample"],
        featureSubsetStrategy=str(params["colsample"]) if params["colsample"] < 1 else "all",
        seed=params["seed"],
        featuresCol=FEATURES,
        labelCol=frame.label,
        predictionCol=f"{frame.prefix}_prediction",
    )
    trees = trees.setProbabilityCol(f"{frame.prefix}_probability").setRawPredictionCol(f"{frame.prefix}_raw")
    if frame.validation:
        trees = trees.setValidationIndicatorCol(frame.validation)
    return trees


def _kernel_svm(params: Mapping[str, Any], frame: Frame) -> Estimator:
    """Standardised inputs, Nyström features, a linear SVM and a logistic fit of its margin.

    The features are not scaled again: their length is the kernel's, which C weighs the loss against.
    """
    prefix = frame.prefix
    return Pipeline(
        stages=[
            StandardScaler(withMean=True, inputCol=FEATURES, outputCol=f"{prefix}_scaled"),
            Nystroem(
                inputCol=f"{prefix}_scaled",
                outputCol=f"{prefix}_kernel",
                landmarks=params["landmarks"],
                gamma=params["gamma"],
                seed=params["seed"],
            ),
            LinearSVC(
                featuresCol=f"{prefix}_kernel",
                labelCol=frame.label,
                predictionCol=f"{prefix}_side",
                rawPredictionCol=f"{prefix}_margin",
                regParam=1 / (params["C"] * frame.rows),
                maxIter=params["max_iter"],
                standardization=False,
                **frame.weights(),
            ),
            LogisticRegression(
                **{**frame.outputs(), "featuresCol": f"{prefix}_margin"}, regParam=1e-6, **frame.weights()
            ),
        ]
    )


def _network(params: Mapping[str, Any], frame: Frame) -> Estimator:
    """Standardised inputs and a feed-forward network."""
    prefix = frame.prefix
    return Pipeline(
        stages=[
            StandardScaler(withMean=True, inputCol=FEATURES, outputCol=f"{prefix}_scaled"),
            MultilayerPerceptronClassifier(
                **{**frame.outputs(), "featuresCol": f"{prefix}_scaled"},
                layers=[frame.features, *params["hidden"], 2],
                maxIter=params["max_iter"],
                seed=params["seed"],
            ),
        ]
    )


def _log_uniform(low: float, high: float) -> Callable[[random.Random], float]:
    return lambda draw: math.exp(draw.uniform(math.log(low), math.log(high)))


MODELS = {
    model.name: model
    for model in (
        Model(
            "logistic_regression",
            {"C": 1.0, "l1_ratio": 0.0, "max_iter": 1000},
            _logistic,
            {"C": _log_uniform(0.01, 100.0), "max_iter": lambda draw: draw.randint(500, 2000)},
        ),
        Model(
            "random_forest",
            {"n_estimators": 100, "max_depth": 10, "min_samples_leaf": 2, "max_features": "sqrt", "seed": 42},
            _forest,
            {
                "n_estimators": lambda draw: draw.randint(50, 300),
                "max_depth": lambda draw: draw.randint(3, 20),
                "min_samples_leaf": lambda draw: draw.randint(1, 10),
                "max_features": lambda draw: draw.choice(["sqrt", "log2", "all"]),
            },
        ),
        Model(
            "gradient_boosting",
            {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample": 1.0, "seed": 42},
            _boosted,
            {
                "n_estimators": lambda draw: draw.randint(50, 300),
                "max_depth": lambda draw: draw.randint(3, 10),
                "learning_rate": lambda draw: draw.uniform(0.01, 0.3),
                "subsample": lambda draw: draw.uniform(0.6, 1.0),
            },
        ),
        Model(
            "early_stopping_boosting",
            {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.1, "subsample": 0.8, "colsample": 0.8, "seed": 42},
            _boosted,
            {
                "n_estimators": lambda draw: draw.randint(50, 300),
                "max_depth": lambda draw: draw.randint(3, 12),
                "learning_rate": lambda draw: draw.uniform(0.01, 0.3),
                "subsample": lambda draw: draw.uniform(0.6, 1.0),
                "colsample": lambda draw: draw.uniform(0.6, 1.0),
            },
        ),
        Model(
            "kernel_svm",
            {"C": 1.0, "landmarks": 256, "gamma": 0.0, "max_iter": 100, "seed": 42},
            _kernel_svm,
            {"C": _log_uniform(0.01, 100.0), "gamma": _log_uniform(0.001, 10.0)},
        ),
        Model(
            "neural_network",
            {"hidden": [100], "max_iter": 500, "seed": 42},
            _network,
            {"hidden": lambda draw: [draw.randint(50, 200), draw.randint(25, 100)]},
        ),
    )
}


def register(model: Model) -> None:
    """Adds a model of the caller's own under its name."""
    MODELS[model.name] = model
