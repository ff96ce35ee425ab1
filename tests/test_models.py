"""Models learn, keep keys, store and load; evaluation tables hang together."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickerloom.models import kernel, text_vectors, training
from tickerloom.models.estimators import MODELS
from tickerloom.operators import profile, splits
from tickerloom.plans import evaluation


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(11)
    days, tickers = pd.date_range("2024-01-01", periods=80).date, ["A", "B", "C", "D"]
    data = pd.DataFrame([(t, d) for d in days for t in tickers], columns=["ticker", "date"])
    data["x"], data["z"] = draw.normal(size=len(data)), draw.normal(size=len(data))
    data["y"] = ((data["x"] ** 2 + 0.2 * draw.normal(size=len(data))) > 0.6).astype(int)
    data["up"] = (data["x"] + 0.3 * draw.normal(size=len(data)) > 0).astype(int)
    data["next_day_return"] = 0.01 * data["x"]
    return spark.createDataFrame(data).repartition(2).persist()


FEATURES = ["x", "z"]


def test_forest_learns_and_is_stored(spark, table, tmp_path):
    model = training.train(table, "y", FEATURES, "random_forest", {"n_estimators": 10, "max_depth": 4})
    assert training.evaluate(model, table).first()["accuracy"] > 0.85
    assert model.importance(spark).first()["feature"] == "x"
    model.save(spark, str(tmp_path / "m"))
    again = training.load_model(spark, str(tmp_path / "m"))
    name = "random_forest_probability"
    both = model.predict(table).select("ticker", "date", F.col(name).alias("a")).join(
        again.predict(table).select("ticker", "date", F.col(name).alias("b")), ["ticker", "date"]
    )
    assert both.count() == table.count() and both.where("a <> b").isEmpty()


def test_kernel_svm_bends_where_a_line_cannot(table):
    svm = training.train(table, "y", FEATURES, "kernel_svm", {"landmarks": 64, "max_iter": 30})
    line = training.train(table, "y", FEATURES, "logistic_regression")
    assert training.evaluate(svm, table).first()["accuracy"] > training.evaluate(line, table).first()["accuracy"] + 0.05


def exact_margins(x, y, weights, gamma, rounds=200):
    """Decision values of the weighted soft-margin RBF machine with a bias, by dual coordinate ascent."""
    block = kernel.rbf(x, x, gamma) + 1
    signs, alpha = 2.0 * y - 1, np.zeros(len(y))
    margins = np.zeros(len(y))
    for _ in range(rounds):
        for i in range(len(y)):
            step = np.clip(alpha[i] + (1 - signs[i] * margins[i]) / block[i, i], 0, weights[i]) - alpha[i]
            alpha[i] += step
            margins += step * signs[i] * block[i]
    return margins


def test_kernel_svm_decides_as_the_exact_machine(table):
    rows = table.select("ticker", "date", "x", "z", "y").toPandas()
    x, y = rows[["x", "z"]].to_numpy(), rows["y"].to_numpy()
    scaled = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    weights = len(y) / (2 * np.bincount(y))[y]
    exact = exact_margins(scaled, y, weights, 0.5)
    model = training.train(table, "y", FEATURES, "kernel_svm", {"landmarks": 80})
    # The side of the margin; the probability is a logistic fit on top of it.
    scored = model.pipeline.transform(training._assemble(table, FEATURES)).toPandas()
    found = scored.set_index(["ticker", "date"])["kernel_svm_side"].loc[list(zip(rows["ticker"], rows["date"]))].to_numpy()
    assert (found == (exact > 0)).mean() >= 0.95


def test_landmarks_of_all_rows_give_the_kernel_itself():
    draw = np.random.default_rng(3)
    places, others = draw.normal(size=(30, 4)), draw.normal(size=(200, 4))
    white = kernel.whitening(places, 0.25)
    own = kernel.rbf(places, places, 0.25) @ white
    assert np.allclose(own @ own.T, kernel.rbf(places, places, 0.25), atol=1e-8)
    # Leverage prefers a lone row to one of many neighbours; a pool that is small enough is taken whole.
    crowd = np.vstack([1e-3 * draw.normal(size=(199, 4)), np.full((1, 4), 9.0)])
    score = kernel.leverages(kernel.rbf(crowd, crowd, 0.25), 2.0)
    assert score.argmax() == 199 and score[:199].max() < 0.1
    assert len(kernel.choose_landmarks(others, 500, 0.25, 1)) == 200 and len(kernel.choose_landmarks(others, 20, 0.25, 1)) == 20


def test_landmarks_are_distinct_rows_and_stored(spark, table, tmp_path):
    copies = table.unionByName(table.where("ticker = 'A'").limit(1).crossJoin(spark.range(2000)).drop("id"))
    model = training.train(copies, "y", FEATURES, "kernel_svm", {"landmarks": 20, "max_iter": 5})
    places = np.array(model.pipeline.stages[1].getOrDefault("landmarks")).reshape(-1, 2)
    assert len(places) == 20 and len(np.unique(places, axis=0)) == 20
    model.save(spark, str(tmp_path / "svm"))
    again = training.load_model(spark, str(tmp_path / "svm")).predict(table)
    name = "kernel_svm_probability"
    first = {(r["ticker"], r["date"]): r[name] for r in model.predict(table).collect()}
    assert all(abs(first[r["ticker"], r["date"]] - r[name]) < 1e-9 for r in again.collect())


def test_rungs_end_with_one_trial_on_all_rows():
    assert training.rungs(9, 3) == [(9, 1 / 9), (3, 1 / 3), (1, 1.0)]
    assert training.rungs(1, 3) == [(1, 1.0)]
    assert [count for count, _ in training.rungs(50, 3)] == [50, 17, 6, 2, 1]
    with pytest.raises(ValueError):
        training.rungs(0, 3)


def test_search_finds_the_planted_parameters(table):
    # A huge penalty predicts one class; a network without inputs to its hidden layer can't be built.
    bad = [{"C": 1e-9, "max_iter": 5} for _ in range(4)]
    found = training.search(
        table, "up", FEATURES, ["ticker", "date"], "logistic_regression", trials=6, folds=2,
        candidates=[*bad, {"C": -1.0, "max_iter": 5}, {"C": 10.0, "max_iter": 100}],
    )
    assert len(found) == 6 and found[0]["params"]["C"] == 10.0
    assert found[0]["share"] == 1.0 and found[0]["score"] > 0.85 and found[-1]["rung"] == 0
    failed = [trial for trial in found if trial["params"]["C"] < 0]
    assert failed[0]["score"] is None and failed[0]["rung"] == 0


def test_every_model_has_a_search_space():
    assert all(model.space for model in MODELS.values())


def test_early_stopping_needs_no_more_trees(table):
    rows = splits.with_tail_split(table)
    model = training.train(rows, "up", FEATURES, "early_stopping_boosting", {"n_estimators": 20, "max_depth": 2}, "is_validation")
    assert 1 <= model.pipeline.stages[-1].getNumTrees <= 20


def test_train_all_skips_failures_and_votes(table):
    names = {"logistic_regression": {}, "random_forest": {"n_estimators": 5}, "neural_network": {"hidden": [0]}}
    fitted, results = training.train_all(table, table, "up", FEATURES, names)
    assert set(fitted) == {"logistic_regression", "random_forest"} and results.count() == 2
    voted = training.soft_vote(fitted.values(), table)
    row = voted.agg(F.avg((F.col("ensemble_prediction") == F.col("up")).cast("int")), F.count("*")).first()
    assert row[0] > 0.8 and row[1] == table.count()


def test_walk_forward_trains_on_the_past(table):
    results = training.walk_forward(table, "up", FEATURES, "logistic_regression", 3)
    assert results.count() == 3 and training.walk_forward_summary(results).first()["mean_accuracy"] > 0.75
    folds = splits.time_folds(splits.with_time_blocks(table, 3), 3).collect()
    ends = {row["fold"]: row["last_date"] for row in folds if row["role"] == "train"}
    for row in folds:
        if row["role"] == "test":
            assert row["first_date"] >= ends[row["fold"]] and row["rows"] == table.count() // 4


def test_backtest_tables(table):
    model = training.train(table, "up", FEATURES, "logistic_regression")
    tables = evaluation.backtest_model(model, table)
    positions, returns = tables["positions"].first(), tables["returns"].first()
    assert positions["total_positions"] == table.count()
    assert returns["excess_return"] == pytest.approx(returns["total_return"] - returns["buy_hold_total_return"])
    assert tables["monthly"].agg(F.sum("return_count")).first()[0] == table.count()
    assert evaluation.report_lines(tables, "m").where("section = 'risk' AND measure = 'sharpe_ratio'").count() == 1


def test_selected_features(table):
    assert training.select_features(table, "up", FEATURES, 1) == ["x"]


def test_tfidf_rows_are_unit_vectors(spark):
    df = spark.createDataFrame([(0, "red green red blue"), (1, "green blue"), (2, "red green"), (3, None)], "k int, t string")
    model = text_vectors.fit_tfidf(df, "t", "k", stop_words=["the"])
    assert model.terms == ["blue", "green", "red", "red green"]
    weights = text_vectors.tfidf_weights(df, model, "t", "k").groupBy("k").agg(F.sum(F.pow("weight", F.lit(2))).alias("n"))
    assert all(row["n"] == pytest.approx(1) for row in weights.collect()) and weights.count() == 3
    parts = text_vectors.with_components(model.transform(df, "t"), model, 2)
    means = parts.agg(F.avg("tfidf_pca_0"), F.avg("tfidf_pca_1")).first()
    assert abs(means[0]) < 1e-12 and abs(means[1]) < 1e-12


def test_student_tail():
    # Closed forms at one and two degrees of freedom, and the normal limit.
    assert profile.student_two_sided(1.0, 1) == pytest.approx(0.5)
    assert profile.student_two_sided(2.0, 2) == pytest.approx(1 - 2 / 6**0.5)
    assert profile.student_two_sided(1.959963985, 1e7) == pytest.approx(0.05, abs=1e-6)
