"""TF-IDF, model fitting, validation, ensembles, evaluation and the feature job.

Fitted models have no SQL counterpart; their tables are checked by tests on properties.
Model sizes are small here because the point is the job, not the score.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from catalog.cleaning_queries import RETURNS
from catalog.registry import query
from catalog.sql_text import quoted
from catalog.window_queries import TECHNICAL_SQL, W, roll
from tickerloom.functions import fixed_values as fixed
from tickerloom.functions.numeric import rolling
from tickerloom.models import text_vectors, training
from tickerloom.operators import metrics, panel_features, splits, technical
from tickerloom.plans import evaluation, jobs
from tickerloom.session import materialize

TERMS_SQL = f"""SELECT doc_id, unnest(list_concat(k, list_transform(range(1, greatest(len(k), 1)), lambda i: k[i] || ' ' || k[i + 1]))) AS term
  FROM (SELECT doc_id, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]{{2,}}'), lambda w: w NOT IN ({quoted(fixed.ENGLISH_STOP_WORDS)})) AS k FROM documents)"""
VOCABULARY_SQL = f"""SELECT term, sum(n)::BIGINT AS occurrences, count(*) AS documents
  FROM (SELECT doc_id, term, count(*) AS n FROM ({TERMS_SQL}) GROUP BY doc_id, term) GROUP BY term HAVING count(*) >= 2
  ORDER BY occurrences DESC, term LIMIT 1000"""


def term_histograms(t) -> DataFrame:
    return text_vectors.histograms(t.documents, "text", "doc_id", fixed.ENGLISH_STOP_WORDS)


def fitted_tfidf(t, counted: DataFrame | None = None):
    return text_vectors.fit_tfidf(t.documents, "text", "doc_id", stop_words=fixed.ENGLISH_STOP_WORDS, counted=counted)


query("tfidf_vocabulary", "", VOCABULARY_SQL)(lambda t: text_vectors.vocabulary(term_histograms(t)))

query(
    "tfidf_weights",
    "weight",
    f"""WITH c AS (SELECT doc_id, term, count(*) AS n FROM ({TERMS_SQL}) GROUP BY doc_id, term),
          w AS (SELECT c.doc_id, c.term, n * (ln((1 + (SELECT count(*) FROM documents)) / (1 + documents)) + 1) AS x FROM c JOIN ({VOCABULARY_SQL}) v ON v.term = c.term)
        SELECT doc_id, term, x / sqrt(sum(x * x) OVER (PARTITION BY doc_id)) AS weight FROM w""",
)(lambda t: weights_of(t))


def weights_of(t) -> DataFrame:
    counted = term_histograms(t)
    return text_vectors.tfidf_weights(t.documents, fitted_tfidf(t, counted), "text", "doc_id", counted)


COMPONENTS = 50


@query("tfidf_components", " ".join(f"tfidf_pca_{i}" for i in range(COMPONENTS)))
def tfidf_components(t):
    counted = term_histograms(t)
    model = fitted_tfidf(t, counted)
    vectors = model.transform(t.documents, "text", counted=counted)
    return text_vectors.with_components(vectors, model, COMPONENTS).select(
        "doc_id", *[f"tfidf_pca_{i}" for i in range(COMPONENTS)]
    )


FEATURES = ["return_lag_1", "return_lag_2", "volatility_5d", "volume_ratio", "price_vs_sma_5", "rsi_14"]
TARGET = "target_direction_1d"


def feature_table(t) -> DataFrame:
    features = panel_features.target_variables(technical.lag_features(technical.technical_features(t.returns)))
    return features.select("ticker", "date", *FEATURES, TARGET, F.col("target_return_1d").alias("next_day_return"))


query(
    "prepare_data",
    "sma_20:4 volatility_5d",
    f"""SELECT ticker, date, coalesce({roll('avg', 'close', 20)}, 0) AS sma_20, coalesce({roll('stddev_samp', 'daily_return', 5)}, 0) AS volatility_5d,
          lead(close, 1) OVER (PARTITION BY ticker ORDER BY date) > close AS up FROM ({RETURNS}) QUALIFY up IS NOT NULL""",
)(
    lambda t: training.prepare_data(
        t.returns.select(
            "ticker",
            "date",
            rolling(F.avg, "close", 20).alias("sma_20"),
            rolling(F.stddev_samp, "daily_return", 5).alias("volatility_5d"),
            (technical.forward_return(1) > 0).alias("up"),
        ),
        "up",
        ["sma_20", "volatility_5d"],
    )
)

SMALL = {
    "logistic_regression": {},
    "random_forest": {"n_estimators": 10, "max_depth": 5},
    "gradient_boosting": {"n_estimators": 5, "max_depth": 3},
    "early_stopping_boosting": {"n_estimators": 5, "max_depth": 3},
    "kernel_svm": {},
    "neural_network": {"hidden": [8], "max_iter": 30},
}
METRIC_DOUBLES = (
    "accuracy precision recall f1_score specificity sensitivity positive_predictive_value negative_predictive_value roc_auc"
)


def prepared(t) -> dict[str, DataFrame]:
    return splits.split_by_date(materialize(training.prepare_data(feature_table(t), TARGET, FEATURES)))


for model_name, small in SMALL.items():

    @query(f"model_{model_name}", METRIC_DOUBLES)
    def fit_and_evaluate(t, model_name=model_name, small=small):
        parts = prepared(t)
        rows, validation = parts["train"], None
        if model_name == "early_stopping_boosting":
            rows, validation = splits.with_tail_split(rows), "is_validation"
        model = training.train(rows, TARGET, FEATURES, model_name, small, validation)
        return training.evaluate(model, parts["val"])


@query("model_predictions", "random_forest_probability")
def model_predictions(t):
    parts = prepared(t)
    model = training.train(parts["train"], TARGET, FEATURES, "random_forest", SMALL["random_forest"])
    return model.predict(parts["test"]).select("ticker", "date", "random_forest_prediction", "random_forest_probability")


@query("feature_importance", "importance")
def feature_importance(t):
    model = training.train(prepared(t)["train"], TARGET, FEATURES, "random_forest", SMALL["random_forest"])
    return model.importance(t.spark).limit(20)


@query("cross_validation", "cv_mean cv_std")
def cross_validation(t):
    rows = prepared(t)["train"]
    results = training.cross_validate(
        rows, TARGET, FEATURES, ["ticker", "date"], "logistic_regression", 5, SMALL["logistic_regression"]
    )
    return training.cross_validation_summary(results)


@query("walk_forward", METRIC_DOUBLES)
def walk_forward(t):
    rows = training.prepare_data(feature_table(t), TARGET, FEATURES)
    return training.walk_forward(rows, TARGET, FEATURES, "logistic_regression", 5, SMALL["logistic_regression"])


@query("parameter_search", "score share")
def parameter_search(t):
    """Nine trials over the whole search space; the last one is trained on all rows."""
    found = training.search(prepared(t)["train"], TARGET, FEATURES, ["ticker", "date"], "logistic_regression", trials=9)
    rows = [(i + 1, str(sorted(trial["params"].items())), trial["score"], trial["rung"], trial["share"]) for i, trial in enumerate(found)]
    return t.spark.createDataFrame(rows, "rank int, params string, score double, rung int, share double")


@query("train_all_models", METRIC_DOUBLES)
def train_all_models(t):
    parts = prepared(t)
    names = {name: SMALL[name] for name in ("logistic_regression", "random_forest", "gradient_boosting")}
    _, results = training.train_all(parts["train"], parts["val"], TARGET, FEATURES, names)
    return metrics.best_first(results, "accuracy")


@query("soft_vote", "ensemble_probability")
def soft_vote(t):
    parts = prepared(t)
    models = [training.train(parts["train"], TARGET, FEATURES, n, SMALL[n]) for n in ("logistic_regression", "random_forest")]
    return training.soft_vote(models, parts["test"]).select(
        "ticker", "date", "ensemble_probability", "ensemble_prediction", "ensemble_vote"
    )


# Analysis of variance: spread between the classes' means against the spread within, per feature.
FEATURE_SQL = f"""SELECT ticker, date, coalesce(lag(daily_return, 1) OVER ({W}), 0) AS return_lag_1, coalesce(lag(daily_return, 2) OVER ({W}), 0) AS return_lag_2,
    coalesce(volatility_5d, 0) AS volatility_5d, coalesce(volume_ratio, 0) AS volume_ratio, coalesce(price_vs_sma_5, 0) AS price_vs_sma_5, coalesce(rsi_14, 0) AS rsi_14,
    coalesce(lead(close, 1) OVER ({W}) / close - 1 > 0, false)::INT AS y FROM ({TECHNICAL_SQL})"""
SELECTED_SQL = f"""WITH f AS MATERIALIZED ({FEATURE_SQL}),
    c AS ({' UNION ALL '.join(f"SELECT '{name}' AS feature, y, count(*) AS n, avg({name}) AS m, var_pop({name}) * count(*) AS within FROM f GROUP BY y" for name in FEATURES)}),
    a AS (SELECT feature, sum(n) AS total, count(*) AS k, sum(n * m) / sum(n) AS mean, sum(within) AS within FROM c GROUP BY feature)
  SELECT feature FROM (SELECT a.feature, (sum(c.n * (c.m - a.mean) * (c.m - a.mean)) / (any_value(k) - 1)) / (any_value(a.within) / (any_value(total) - any_value(k))) AS score
    FROM c JOIN a ON a.feature = c.feature GROUP BY a.feature) ORDER BY score DESC LIMIT 3"""


@query("selected_features", "", SELECTED_SQL)
def selected_features(t):
    rows = training.prepare_data(feature_table(t), TARGET, FEATURES)
    chosen = training.select_features(rows, TARGET, FEATURES, 3)
    return t.spark.createDataFrame([(name,) for name in chosen], "feature string")


@query("backtest_model", "value")
def backtest_model(t):
    features = feature_table(t).withColumn("next_day_return", F.col("next_day_return") / 1000)
    parts = splits.split_by_date(materialize(features.where(F.col("next_day_return").isNotNull())))
    model = training.train(parts["train"], TARGET, FEATURES, "logistic_regression", SMALL["logistic_regression"])
    return evaluation.report_lines(evaluation.backtest_model(model, parts["test"]), model.name)


@query("feature_job", "*")
def feature_job(t):
    """The panel of cleaned news and bars, all features, gaps filled."""
    panel = jobs.with_sentiment(jobs.merged_panel(t.news, t.bars, ["doc_id"]))
    return jobs.feature_panel(panel)


@query("feature_families")
def feature_families(t):
    """Columns per family of the feature table, with its row count."""
    from tickerloom.operators import profile

    features = panel_features.all_features(t.returns)
    counts = [
        F.struct(F.lit(family).alias("family"), F.lit(n).alias("features"))
        for family, n in profile.feature_families(features.columns).items()
    ]
    rows = t.bars.agg(F.count("*").alias("rows"))
    return rows.select("rows", F.inline(F.array(*counts)))


