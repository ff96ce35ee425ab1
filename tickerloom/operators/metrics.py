"""Classification metrics from label, prediction and score columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, Window, functions as F

from tickerloom.functions import calendar
from tickerloom.operators.quantiles import RUNNING, with_buckets


def confusion_matrix(df: DataFrame, label: str = "y_true", prediction: str = "y_pred") -> DataFrame:
    return df.groupBy(label, prediction).agg(F.count("*").alias("count"))


def class_report(df: DataFrame, label: str = "y_true", prediction: str = "y_pred") -> DataFrame:
    """Precision, recall, F1 and support per class; a division by nothing gives 0."""
    matrix = confusion_matrix(df, label, prediction)
    hit = F.when(F.col(label) == F.col(prediction), F.col("count")).otherwise(0)
    nothing = F.lit(0).cast("bigint")
    as_label = F.struct(F.col(label).alias("class"), F.col("count").alias("support"), nothing.alias("predicted"), hit.alias("hits"))
    as_prediction = F.struct(
        F.col(prediction).alias("class"), nothing.alias("support"), F.col("count").alias("predicted"), nothing.alias("hits")
    )
    per_class = (
        matrix.select(F.inline(F.array(as_label, as_prediction)))
        .groupBy("class")
        .agg(F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits"))
    )
    precision = F.coalesce(F.try_divide(F.col("hits"), F.col("predicted")), F.lit(0.0))
    recall = F.coalesce(F.try_divide(F.col("hits"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return (
        per_class.withColumns({"precision": precision, "recall": recall})
        .withColumn("f1_score", f1)
        .select("class", "precision", "recall", "f1_score", "support", "hits")
    )


def weighted_metrics(df: DataFrame, label: str = "y_true", prediction: str = "y_pred") -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1 (one row)."""
    report = class_report(df, label, prediction)
    total = F.sum("support")
    return report.agg(
        F.try_divide(F.sum("hits"), total).alias("accuracy"),
        *[
            F.try_divide(F.sum(F.col(name) * F.col("support")), total).alias(name)
            for name in ("precision", "recall", "f1_score")
        ],
        total.alias("n_samples"),
    )


def binary_counts(df: DataFrame, label: str = "y_true", prediction: str = "y_pred") -> DataFrame:
    """True and false positives and negatives with the four rates (0 without cases)."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    counts = df.agg(
        F.count_if(y & p).alias("true_positives"),
        F.count_if(~y & ~p).alias("true_negatives"),
        F.count_if(~y & p).alias("false_positives"),
        F.count_if(y & ~p).alias("false_negatives"),
    )
    tp, tn, fp, fn = (F.col(name) for name in counts.columns)

    def rate(part, other):
        return F.coalesce(F.try_divide(part, part + other), F.lit(0.0))

    return counts.withColumns(
        {
            "specificity": rate(tn, fp),
            "sensitivity": rate(tp, fn),
            "positive_predictive_value": rate(tp, fp),
            "negative_predictive_value": rate(tn, fn),
        }
    )


def score_ranks(df: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with their cases and the cases at lower scores.

    Counts per distinct score are reduced map-side; the running totals go by buckets of
    the score, so no task orders all scores.
    """
    counts = (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(F.col(label) == 1).alias("positives"), F.count_if(F.col(label) != 1).alias("negatives"))
    )
    bucketed = with_buckets(counts, ["score"]).withColumnRenamed("_bucket_score", "bucket")
    kinds = ("positives", "negatives")
    totals = bucketed.groupBy("bucket").agg(*[F.sum(kind).alias(f"{kind}_in") for kind in kinds])
    # A few hundred buckets: their order is one small window.
    by_bucket = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    starts = totals.select(
        "bucket",
        *[F.coalesce(F.sum(f"{kind}_in").over(by_bucket), F.lit(0)).alias(f"{kind}_start") for kind in kinds],
        *[F.sum(f"{kind}_in").over(everything).alias(f"all_{kind}") for kind in kinds],
    )
    inside = Window.partitionBy("bucket").orderBy("score").rowsBetween(*RUNNING)
    joined = bucketed.join(starts, "bucket")
    return joined.select(
        "score",
        *kinds,
        *[
            (F.col(f"{kind}_start") + F.sum(kind).over(inside) - F.col(kind)).alias(f"{kind}_below") for kind in kinds
        ],
        *[f"all_{kind}" for kind in kinds],
    )


def roc_auc(df: DataFrame, label: str = "y_true", score: str = "y_proba") -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties half; null with one class."""
    ranks = score_ranks(df, label, score)
    ordered = F.col("positives").cast("double") * (F.col("negatives_below") + F.col("negatives") / 2)
    pairs = F.max("all_positives").cast("double") * F.max("all_negatives")
    return ranks.agg(F.try_divide(F.sum(ordered), F.when(pairs > 0, pairs)).alias("roc_auc"))


def roc_auc_one_vs_rest(df: DataFrame, label: str, scores: Mapping[int, str]) -> DataFrame:
    """Prevalence-weighted mean of every class's AUC against the rest (one row)."""
    parts = None
    for value, column in scores.items():
        flagged = df.select((F.col(label) == value).cast("int").alias("y"), F.col(column).alias("s"))
        ranks = score_ranks(flagged, "y", "s")
        ordered = F.col("positives").cast("double") * (F.col("negatives_below") + F.col("negatives") / 2)
        p, n = F.max("all_positives"), F.max("all_negatives")
        part = ranks.agg(F.try_divide(F.sum(ordered), p.cast("double") * n).alias("auc"), p.alias("weight"))
        parts = part if parts is None else parts.unionByName(part)
    return parts.agg(F.try_divide(F.sum(F.col("auc") * F.col("weight")), F.sum("weight")).alias("roc_auc"))


def roc_curve(df: DataFrame, label: str = "y_true", score: str = "y_proba") -> DataFrame:
    """False and true positive rate at every distinct threshold, and the start (0, 0)."""
    ranks = score_ranks(df, label, score)
    fpr = F.try_divide(F.col("all_negatives") - F.col("negatives_below"), F.col("all_negatives"))
    tpr = F.try_divide(F.col("all_positives") - F.col("positives_below"), F.col("all_positives"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return ranks.select(F.col("score").alias("threshold"), fpr.alias("fpr"), tpr.alias("tpr")).unionByName(start)


def classification_metrics(
    df: DataFrame, label: str = "y_true", prediction: str = "y_pred", score: str | None = None
) -> DataFrame:
    """All binary measures as one row; three small aggregates side by side."""
    one = F.lit(1).alias("_one")
    result = weighted_metrics(df, label, prediction).select("*", one)
    result = result.join(binary_counts(df, label, prediction).select("*", one), "_one")
    if score is not None:
        result = result.join(roc_auc(df, label, score).select("*", one), "_one")
    return result.drop("_one")


def period_performance(df: DataFrame, period: str) -> DataFrame:
    """Mean label, accuracy, mean signal and return statistics per 'month' or 'quarter'."""
    start = calendar.month_of(F.col("date")) if period == "month" else calendar.quarter_of(F.col("date"))
    return df.groupBy(start.alias("period")).agg(
        F.bround(F.avg("y_true"), 4).alias("positive_rate"),
        F.bround(F.avg((F.col("y_pred") == F.col("y_true")).cast("double")), 4).alias("accuracy"),
        F.bround(F.avg("signal"), 4).alias("mean_signal"),
        F.bround(F.sum("actual_return"), 4).alias("return_sum"),
        F.bround(F.stddev_samp("actual_return"), 4).alias("return_std"),
        F.count("actual_return").alias("return_count"),
    )


def evaluation_span(df: DataFrame) -> DataFrame:
    return df.agg(
        F.min("date").alias("first_date"), F.max("date").alias("last_date"), F.count("*").alias("total_periods")
    )


def accuracy_by(df: DataFrame, key: str = "ticker", label: str = "y_true", prediction: str = "y_pred") -> DataFrame:
    correct = (F.col(label) == F.col(prediction)).cast("int")
    return df.groupBy(key).agg(
        F.count("*").alias("total_samples"),
        F.sum(correct).alias("correct_predictions"),
        F.bround(F.avg(correct), 3).alias("accuracy"),
        F.bround(F.avg(label), 3).alias("positive_rate"),
    )


def accuracy_spread(per_key: DataFrame) -> DataFrame:
    return per_key.agg(F.stddev_samp("accuracy").alias("accuracy_std"))


def prediction_profile(
    df: DataFrame, confidence: str = "pred_confidence", prediction: str = "pred_direction", label: str = "y_true"
) -> DataFrame:
    """Confident predictions and their accuracy, mean confidence, bullish and bearish share."""
    sure = F.col(confidence) > 0.7
    right = (F.col(prediction) == F.col(label)).cast("double")
    rows = F.count("*")
    return df.agg(
        F.avg(right).alias("accuracy"),
        F.count_if(sure).alias("confident"),
        (F.count_if(sure) / rows).alias("confident_share"),
        F.coalesce(F.avg(F.when(sure, right)), F.lit(0.0)).alias("confident_accuracy"),
        F.avg(confidence).alias("mean_confidence"),
        (F.count_if(F.col(prediction) == 1) / rows).alias("bullish_share"),
        (F.count_if(F.col(prediction) == 0) / rows).alias("bearish_share"),
    )


def ensemble_average(probabilities: Iterable[str]):
    """Mean probability and its class (above one half)."""
    names = list(probabilities)
    mean = sum((F.col(name) for name in names), F.lit(0.0)) / len(names)
    return mean, (mean > 0.5).cast("int")


def ensemble_vote(predictions: Iterable[str]):
    """Rounded mean vote; an even split rounds half to even."""
    names = list(predictions)
    return F.bround(sum((F.col(name) for name in names), F.lit(0.0)) / len(names), 0).cast("int")


def best_first(results: DataFrame, metric: str, top: int | None = None) -> DataFrame:
    """Model results by a metric, best first; the name breaks ties."""
    ranked = results.orderBy(F.desc_nulls_last(metric), "model")
    return ranked.limit(top) if top else ranked
