"""Fitting, prediction, validation, search, ensembles and stored models."""

from __future__ import annotations

import json
import logging
import math
import random
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.ml.feature import UnivariateFeatureSelector, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickerloom.models.estimators import FEATURES, MODELS, Frame
from tickerloom.operators import cleaning, metrics, splits
from tickerloom.session import materialize
from tickerloom.sources.sinks import write_metadata

log = logging.getLogger(__name__)


def prepare_data(df: DataFrame, target: str, features: Iterable[str] | None = None) -> DataFrame:
    """Rows with a target, missing features as 0. Features default to the numeric roles."""
    names = list(features) if features is not None else cleaning.feature_columns(df)
    if target not in df.columns:
        raise ValueError(f"no target column {target}")
    keys = [name for name in ("ticker", "date") if name in df.columns]
    return df.where(F.col(target).isNotNull()).select(
        *[name for name in keys if name not in names],
        *[F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in names],
        target,
    )


@dataclass
class FittedModel:
    name: str
    pipeline: PipelineModel
    features: list[str]
    target: str
    params: dict[str, Any]

    def predict(self, df: DataFrame) -> DataFrame:
        """Adds `<name>_probability` (of class 1) and `<name>_prediction` (0 or 1).

        Works row by row on the caller's columns; keys stay, nothing is joined back.
        """
        scored = self.pipeline.transform(_assemble(df, self.features))
        extra = [name for name in scored.columns if name not in df.columns]
        probability = F.get(vector_to_array(f"{self.name}_probability"), F.lit(1))
        return (
            scored.withColumns({"_p": probability, "_y": F.col(f"{self.name}_prediction").cast("int")})
            .drop(*extra)
            .withColumnsRenamed({"_p": f"{self.name}_probability", "_y": f"{self.name}_prediction"})
        )

    def importance(self, spark: SparkSession) -> DataFrame:
        """Tree importances or absolute coefficients per feature, largest first.

        One row per feature; a model with neither gives none.
        """
        stage = self.pipeline.stages[-1]
        values: list[float] = []
        if hasattr(stage, "featureImportances"):
            values = stage.featureImportances.toArray().tolist()
        elif hasattr(stage, "coefficients") and len(stage.coefficients) == len(self.features):
            values = [abs(value) for value in stage.coefficients.toArray().tolist()]
        rows = list(zip(self.features, values))
        return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.desc("importance"), "feature")

    def save(self, spark: SparkSession, path: str) -> None:
        self.pipeline.write().overwrite().save(f"{path}/pipeline")
        bundle = {"name": self.name, "features": self.features, "target": self.target, "params": self.params}
        write_metadata(spark, bundle, f"{path}/metadata.json")
        self.importance(spark).write.mode("overwrite").json(f"{path}/importance.json")


def load_model(spark: SparkSession, path: str) -> FittedModel:
    bundle = json.loads(spark.read.text(f"{path}/metadata.json").first()[0])
    return FittedModel(pipeline=PipelineModel.load(f"{path}/pipeline"), **bundle)


def _assemble(df: DataFrame, features: list[str]) -> DataFrame:
    filled = {f"_in_{i}": F.coalesce(F.col(name).cast("double"), F.lit(0.0)) for i, name in enumerate(features)}
    inputs = list(filled)
    return VectorAssembler(inputCols=inputs, outputCol=FEATURES).transform(df.withColumns(filled)).drop(*inputs)


# Models whose classes are balanced by weights.
BALANCED = ("logistic_regression", "random_forest", "kernel_svm")


def train(
    df: DataFrame,
    target: str,
    features: Iterable[str],
    name: str,
    params: Mapping[str, Any] | None = None,
    validation: str | None = None,
) -> FittedModel:
    """Fits one model; the training rows stay distributed through Spark ML.

    `validation` names a boolean column of rows held out for early stopping.
    """
    features = list(features)
    model = MODELS[name]
    chosen = {**model.defaults, **(params or {})}
    keep = [validation] if validation else []
    rows = df.where(F.col(target).isNotNull()).select(*features, target, *keep)
    weight = None
    if name in BALANCED:
        weight = "_weight"
        rows = splits.with_class_weight(rows, target, weight)
    assembled = _assemble(rows, features).select(FEATURES, target, *([weight] if weight else []), *keep).persist()
    try:
        frame = Frame(target, assembled.count(), len(features), weight, name, validation)
        fitted = model.build(chosen, frame).fit(assembled)
    finally:
        assembled.unpersist()
    pipeline = fitted if isinstance(fitted, PipelineModel) else PipelineModel([fitted])
    return FittedModel(name, pipeline, features, target, chosen)


def evaluate(model: FittedModel, df: DataFrame) -> DataFrame:
    """Accuracy, weighted precision, recall, F1, the four counts and AUC (one row)."""
    names = [model.target, f"{model.name}_prediction", f"{model.name}_probability"]
    # Several aggregates read the predictions, so the model runs once.
    scored = materialize(model.predict(df.where(F.col(model.target).isNotNull())).select(*names))
    return metrics.classification_metrics(scored, *names).withColumn("model", F.lit(model.name))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def train_all(
    train_df: DataFrame, val_df: DataFrame, target: str, features: Iterable[str], names: Mapping[str, Mapping[str, Any]]
) -> tuple[dict[str, FittedModel], DataFrame]:
    """Fits every named model and evaluates it on the validation rows; failures are skipped."""
    features = list(features)
    fitted: dict[str, FittedModel] = {}
    for name, params in names.items():
        try:
            fitted[name] = train(train_df, target, features, name, params)
        except Exception as error:
            log.warning("training %s failed: %s", name, error)
    if not fitted:
        raise ValueError("no model could be trained")
    results = _union([evaluate(model, val_df) for model in fitted.values()])
    return fitted, results


def cross_validate(
    df: DataFrame, target: str, features: Iterable[str], keys: Iterable[str], name: str, folds: int = 5,
    params: Mapping[str, Any] | None = None,
) -> DataFrame:
    """Accuracy per stratified fold."""
    folded = materialize(splits.with_stratified_fold(df.where(F.col(target).isNotNull()), target, keys, folds))
    parts = []
    for fold in range(folds):
        model = train(folded.where(F.col("fold") != fold), target, features, name, params)
        result = evaluate(model, folded.where(F.col("fold") == fold))
        parts.append(result.withColumn("fold", F.lit(fold)))
    return _union(parts)


def cross_validation_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(
        F.avg("accuracy").alias("cv_mean"), F.stddev_pop("accuracy").alias("cv_std"), F.count("*").alias("folds")
    )


def walk_forward(
    df: DataFrame, target: str, features: Iterable[str], name: str, folds: int = 5, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Metrics per expanding time fold: train on the past blocks, test on the next."""
    blocked = materialize(splits.with_time_blocks(df.where(F.col(target).isNotNull()), folds))
    parts = []
    for fold in range(folds):
        past, ahead = blocked.where(F.col("block") <= fold), blocked.where(F.col("block") == fold + 1)
        model = train(past, target, features, name, params)
        parts.append(evaluate(model, ahead).withColumn("split", F.lit(fold)))
    return _union(parts)


def walk_forward_summary(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(
        F.avg("accuracy").alias("mean_accuracy"),
        F.stddev_samp("accuracy").alias("std_accuracy"),
        F.avg("roc_auc").alias("mean_roc_auc"),
        F.stddev_samp("roc_auc").alias("std_roc_auc"),
        F.count("*").alias("n_splits"),
    )


def rungs(trials: int, eta: int) -> list[tuple[int, float]]:
    """Trials and share of the rows per rung of a halving: an `eta`-th stays each time, until one is left on all rows."""
    if trials < 1 or eta < 2:
        raise ValueError("a search takes one trial and a halving by two at least")
    counts = [trials]
    while counts[-1] > 1:
        counts.append(math.ceil(counts[-1] / eta))
    return [(count, float(eta) ** (at - len(counts) + 1)) for at, count in enumerate(counts)]


def _fold_hits(folded: DataFrame, target: str, features: list[str], name: str, params: Mapping[str, Any], share: float, folds: int) -> DataFrame:
    """One row per fold: rows and correct predictions of a model trained on that share of the other folds."""
    parts = []
    for fold in range(folds):
        kept = folded.where((F.col("fold") != fold) & (F.col("_share") < share))
        scored = train(kept, target, features, name, params).predict(folded.where(F.col("fold") == fold))
        hit = F.col(f"{name}_prediction") == F.col(target)
        parts.append(scored.agg(F.lit(fold).alias("fold"), F.count("*").alias("n"), F.count_if(hit).alias("hits")))
    return _union(parts)


def search(
    df: DataFrame, target: str, features: Iterable[str], keys: Iterable[str], name: str, trials: int = 50,
    folds: int = 3, seed: int = 42, fixed: Mapping[str, Any] | None = None, eta: int = 3,
    candidates: Iterable[Mapping[str, Any]] = (),
) -> list[dict[str, Any]]:
    """Random search by successive halving: sampled parameters (and the `candidates`), best first.

    The folds are dealt and stored once for all trials. A rung trains its trials on a share of each
    training fold, scores them on whole held-out folds in one job, and passes the best `eta`-th on to
    `eta` times the rows; the last rung trains on all rows. The share is by a hash of the keys, so a
    rung's rows hold those of the rung before. A trial that can't be trained is the worst of its rung. Each result has
    `params`, `score` (mean accuracy over the folds in its last rung, null if it failed), `rung` and `share`.
    """
    features, keys, draw = list(features), list(keys), random.Random(seed)
    model = MODELS[name]
    sampled = [dict(params) for params in candidates]
    while len(sampled) < trials:
        sampled.append({key: sample(draw) for key, sample in sorted(model.space.items())})
    narrow = df.where(F.col(target).isNotNull()).select(*dict.fromkeys([*keys, *features, target]))
    order = F.xxhash64(F.lit(seed), *keys)
    shared = narrow.withColumn("_share", F.pmod(order, F.lit(1 << 30)) / (1 << 30))
    folded = materialize(splits.with_stratified_fold(shared, target, keys, folds, seed))
    alive = [{"params": {**params, **(fixed or {})}} for params in sampled]
    done: list[dict[str, Any]] = []
    for rung, (count, share) in enumerate(rungs(len(alive), eta)):
        done, alive = alive[count:] + done, alive[:count]
        measured = []
        for at, trial in enumerate(alive):
            trial.update(score=None, rung=rung, share=share)
            try:
                hits = _fold_hits(folded, target, features, name, trial["params"], share, folds)
                measured.append(hits.withColumn("trial", F.lit(at)))
            except Exception as error:
                log.warning("trial %s of %s failed: %s", trial["params"], name, error)
        if measured:
            accuracy = F.avg(F.col("hits") / F.col("n")).alias("score")
            for row in _union(measured).where("n > 0").groupBy("trial").agg(accuracy).collect():
                alive[row["trial"]]["score"] = row["score"]
        alive.sort(key=lambda trial: -1.0 if trial["score"] is None else trial["score"], reverse=True)
    return alive + done


def predict_all(models: Iterable[FittedModel], df: DataFrame) -> DataFrame:
    """Predictions of every model side by side, one projection after the other."""
    for model in models:
        df = model.predict(df)
    return df


def soft_vote(models: Iterable[FittedModel], df: DataFrame) -> DataFrame:
    """Adds the models' mean probability and its class, and their rounded vote."""
    models = list(models)
    scored = predict_all(models, df)
    mean, label = metrics.ensemble_average([f"{model.name}_probability" for model in models])
    vote = metrics.ensemble_vote([f"{model.name}_prediction" for model in models])
    return scored.withColumns({"ensemble_probability": mean, "ensemble_prediction": label, "ensemble_vote": vote})


def select_features(df: DataFrame, target: str, features: Iterable[str], top: int) -> list[str]:
    """The `top` features by the F statistic between classes."""
    features = list(features)
    selector = UnivariateFeatureSelector(
        featuresCol=FEATURES, labelCol=target, outputCol="_selected", selectionMode="numTopFeatures"
    )
    selector = selector.setFeatureType("continuous").setLabelType("categorical").setSelectionThreshold(top)
    chosen = selector.fit(_assemble(df.where(F.col(target).isNotNull()), features)).selectedFeatures
    return [features[i] for i in sorted(chosen)]
