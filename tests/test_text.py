"""Text functions against Python's own string and pattern functions."""

import re

from pyspark.sql import functions as F

from tickerloom.functions import sentiment, text
from tickerloom.operators import cleaning

SAMPLES = [
    "Reuters - Visit https://a.b/c?x=1 now!  Mail me@x.org, or @home today.",
    "a@ b@@c @@d e@f@g \t http WWW.X.Y \x1c z",
    "All Rights Reserved. Copyright 2024 by Reuters and co.  Terms of USE",
    "I cannot, gonna wait... the U.S. firm's Inc. rose 5%!",
    "　 Ünïcode text: déjà vu; naïve?",
    "",
    None,
]


def column(spark, expression):
    rows = [(i, value) for i, value in enumerate(SAMPLES)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [row[0] for row in df.select(expression(F.col("t")).alias("x"), "i").orderBy("i").select("x").collect()]


def python_clean(value):
    value = (value or "").lower()
    value = re.sub(r"http\S+|www\S+|https\S+", "", value)
    value = re.sub(r"\S+@\S+", "", value)
    return re.sub(r"\s+", " ", re.sub(r"[^a-zA-Z\s.,!?;:]", "", value)).strip()


def test_clean_text(spark):
    assert column(spark, text.clean_text) == [python_clean(value) for value in SAMPLES]


def test_staged_equals_expression(spark):
    df = spark.createDataFrame([(value,) for value in SAMPLES], "t string")
    staged = text.with_preprocessed(df, {"x": "t"}).withColumn("y", text.preprocess_text(F.col("t")))
    assert all(row["x"] == row["y"] for row in staged.collect())


def test_tokens(spark):
    found = column(spark, lambda c: text.tokens(text.clean_text(c)))
    assert found[3] == ["gon", "wait", "...", "u.s", "firms", "inc", "rose"]


def test_boilerplate(spark):
    found = column(spark, lambda c: text.remove_boilerplate(text.clean_text(c)))
    assert found[2] == ".  and co."
    assert column(spark, text.remove_boilerplate)[0].startswith("Visit")


def test_words_and_statistics(spark):
    assert column(spark, text.words)[:4] == [value.split() for value in SAMPLES[:4]]
    lengths = column(spark, lambda c: text.text_statistics(c)["uppercase_ratio"])
    assert lengths[0] == sum(ch.isupper() for ch in SAMPLES[0]) / len(SAMPLES[0])
    assert lengths[5] == lengths[6] == 0


def test_keyword_ratio(spark):
    df = spark.createDataFrame([("Profit surge but LOSS",), ("nothing",), (None,)], "t string")
    positive, negative = sentiment.keyword_counts(F.col("t"))
    rows = df.select(positive, negative, sentiment.sentiment_ratio(positive, negative)).collect()
    assert [tuple(row) for row in rows] == [(2, 1, 1 / 3), (0, 0, 0.0), (0, 0, 0.0)]


def test_clean_news_from_text_times(spark):
    rows = [
        (1, "Reuters - Profits rise again", "A content that is long enough.", "20240805T133000"),
        (0, "Reuters - Profits rise again", "A content that is long enough.", "2024-08-05 10:00:00"),
        (2, "short", "A content that is long enough.", "20240805T133000"),
        (3, "A headline with a bad time", "A content that is long enough.", "soon"),
    ]
    df = spark.createDataFrame(rows, "n int, headline string, content string, timestamp string")
    kept = cleaning.clean_news(df, ["n"]).collect()
    assert [(row["n"], row["headline"]) for row in kept] == [(0, "Profits rise again")]
