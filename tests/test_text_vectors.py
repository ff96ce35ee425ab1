"""TF-IDF at scale: pairs of rare words are never counted, texts are split once, all results stay exact."""

import random
from collections import Counter

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from tickerloom.models import text_vectors

STOPS = ["the", "of"]
ODD = ["Straße_1 naïve CAFÉ ΟΔΟΣ ΟΔΟΣ. x é 東京 東 a_b", "the of\nthe\tOF", "", None, "İstanbul ok\x1cok ½ ²³ \U0001d7d8\U0001d7d9"]


def counted_by_hand(texts):
    occurrences, documents = Counter(), Counter()
    for text in texts:
        kept = [w for w in regex.findall(text_vectors.TOKEN, (text or "").lower()) if w not in STOPS]
        found = Counter(kept) + Counter(map(" ".join, zip(kept, kept[1:])))
        occurrences.update(found)
        documents.update(found.keys())
    return {term: (n, documents[term]) for term, n in occurrences.items()}


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    words = [f"w{n}" for n in range(60)]
    return ODD + [" ".join(draw.choices(words, range(60, 0, -1), k=draw.randrange(30))) for _ in range(200)]


@pytest.mark.parametrize("size", [7, 40, 500, 10_000])
def test_vocabulary_is_exact_whatever_its_size(spark, texts, size):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    found = text_vectors.vocabulary(text_vectors.histograms(df, "t", "k", STOPS), size).collect()
    kept = {term: n for term, n in counted_by_hand(texts).items() if n[1] >= 2}
    expected = sorted(kept.items(), key=lambda item: (-item[1][0], item[0]))[:size]
    assert [(r["term"], (r["occurrences"], r["documents"])) for r in found] == expected


def test_pairs_of_rare_words_are_not_counted(spark, texts, monkeypatch):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    counted = text_vectors.histograms(df, "t", "k", STOPS)
    rows, totals = [], text_vectors._totals

    def watched(found, min_documents, frequent=None, pairs=False):
        result = totals(found, 1, frequent, pairs)
        rows.append(result.count())
        return totals(found, min_documents, frequent, pairs)

    monkeypatch.setattr(text_vectors, "_totals", watched)
    text_vectors.vocabulary(counted, 8)
    assert rows[1] <= 100 < sum(" " in term for term in counted_by_hand(texts))
    monkeypatch.setattr(text_vectors, "FREQUENT_WORDS", 3)
    expected = sorted(counted_by_hand(texts).items(), key=lambda item: (-item[1][0], item[0]))[:8]
    assert [row["term"] for row in text_vectors.vocabulary(counted, 8).collect()] == [term for term, _ in expected]


def test_odd_words_are_those_of_the_pattern(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    rows = {row["k"]: row["words"] for row in text_vectors.histograms(df, "t", "k", STOPS).collect()}
    for k, text in enumerate(texts):
        assert rows[k].split() == [w for w in regex.findall(text_vectors.TOKEN, (text or "").lower()) if w not in STOPS]


def test_components_from_histograms_are_those_of_the_texts(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts[5:])), "k long, t string")
    counted = text_vectors.histograms(df, "t", "k", STOPS)
    model = text_vectors.fit_tfidf(df, "t", "k", max_features=30, counted=counted, stop_words=STOPS)
    plain = {r["k"]: r["tfidf"] for r in model.transform(df, "t").collect()}
    vectors = model.transform(df, "t", counted=counted)
    assert {r["k"]: r["tfidf"] for r in vectors.collect()} == plain
    weights = text_vectors.tfidf_weights(df, model, "t", "k", counted).groupBy("k").agg(F.sum("weight").alias("s")).collect()
    assert {r["k"]: pytest.approx(r["s"]) for r in weights} == {k: sum(v.values) for k, v in plain.items() if len(v.values)}
    rows = text_vectors.with_components(vectors, model, 5).orderBy("k").collect()
    x = np.array([plain[row["k"]].toArray() for row in rows])
    x -= x.mean(axis=0)
    expected = x @ np.linalg.svd(x, full_matrices=False)[2][:5].T
    assert np.allclose(np.abs([[row[f"tfidf_pca_{i}"] for i in range(5)] for row in rows]), np.abs(expected))
