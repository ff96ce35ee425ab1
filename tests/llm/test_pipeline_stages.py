"""Pipeline stages on empty tables, repeated ids, near copies and columns named like helpers."""

from pathlib import Path

import public_tokenizers
import pytest

import corpus_pipeline
from tickerloom.llm.pieces import decode_documents, encode_documents
from tickerloom.llm.pii import find_personal_data
from tickerloom.llm.quality_lines import clean_lines
from tickerloom.llm.toxic_spans import ToxicTagger, words_of
from tickerloom.llm.url_cascade import judge_urls
from tickerloom.session import checkpoint_folder

PIECES = public_tokenizers.path("piece_bpe_32k.model")
HELPERS = ("source_", "words_", "lines_", "hashes_", "ordered_", "worded_", "clean_chars_", "row", "row_", "result_", "keys_", "n_clean_", "source", "target", "number", "d1")


def prose(start: int, words: int = 80) -> str:
    return " ".join(f"word{(start * 31 + i * i * 7) % 997}" for i in range(words)) + "."


def spoken(start: int, words: int) -> str:
    """Prose whose words differ in letters alone."""
    return prose(start, words).translate(str.maketrans("0123456789", "abcdefghij"))


def frame(spark, rows):
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(rows)], "doc_id long, text string, n_chars long")
    return docs.selectExpr("*", *[f"concat('{name}', n_chars) AS {name}" for name in HELPERS])


@pytest.mark.parametrize(
    "operator",
    [find_personal_data, lambda d: decode_documents(encode_documents(d, PIECES), PIECES), clean_lines],
    ids=["personal", "pieces", "lines"],
)
def test_columns_named_like_helpers_stay(spark, operator):
    docs = frame(spark, [(1, prose(1)), (2, None), (3, "mail a@b.example")])
    got = operator(docs)
    assert set(docs.columns) <= set(got.columns)
    expected = {(r["n_chars"], *[r[name] for name in HELPERS]) for r in docs.collect()}
    assert {(r["n_chars"], *[r[name] for name in HELPERS]) for r in got.collect()} == expected


def test_url_columns_named_like_helpers_stay(spark):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/", "mine")], "page_id long, url string, keys_ string")
    row = judge_urls(pages, rules).first()
    assert row["keys_"] == "mine" and row["verdict"] == "block"


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_of_empty_and_odd_tables(spark, tmp_path, name, stage):
    spark.createDataFrame([(1, prose(50, 30))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = frame(spark, [(1, prose(1)), (2, None), (None, prose(2)), (3, ""), (4, prose(3)), (4, prose(3))])
    assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0
    got = stage(spark, docs, str(tmp_path))
    assert set(docs.columns) <= set(got.columns)
    rows = got.collect()
    assert {r["doc_id"] for r in rows} >= {1, 4, None}
    assert all(r["words_"] == f"words_{int(r['words_'][6:])}" for r in rows)


def test_near_copies_go_and_texts_under_one_id_stay(spark, tmp_path):
    copy = prose(1)
    rows = [(1, copy), (2, copy), (3, prose(2)), (3, prose(3)), (5, prose(4)), (5, copy), (6, prose(2)), (3, prose(2)), (None, copy)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.text) for r in corpus_pipeline.near_dedup(spark, docs, "").collect()))
    assert got == sorted([(0, copy), (1, copy), (3, prose(2)), (3, prose(3)), (5, prose(4))])
    unique = spark.createDataFrame([r for r in rows if r[0] in (1, 2, 6, None)], "doc_id long, text string")
    kept = corpus_pipeline.near_dedup(spark, unique, "").collect()
    assert sorted((r.doc_id or 0) for r in kept) == [0, 1, 6]


def test_small_tables_are_few_files(spark):
    """Many shuffle partitions do not become as many files of a few rows each."""
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")
    kept = {name: spark.conf.get(name) for name in names}
    rows = [(i, prose(i // 2 + 1)) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    folder = Path(checkpoint_folder(spark).removeprefix("file://"))
    before = set(folder.glob("llm-*"))
    try:
        spark.conf.set(names[0], "60")
        spark.conf.set(names[1], "false")
        assert corpus_pipeline.near_dedup(spark, docs, "").count() <= 300
    finally:
        for name, value in kept.items():
            spark.conf.set(name, value)
    files = {f.name: len(list(f.glob("table/*.parquet"))) for f in set(folder.glob("llm-*")) - before}
    assert len(files) >= 5 and max(files.values()) <= spark.sparkContext.defaultParallelism, files


def test_capital_i_with_dot_does_not_hide_words(spark):
    texts = [(1, f"you STUPID {spoken(k, 20)}") for k in range(40)] + [(0, spoken(k, 25)) for k in range(100, 220)]
    tagger = ToxicTagger(spark.createDataFrame(texts, "label int, text string"))
    plain, dotted = tagger.score("now STUPID here"), tagger.score("İ now STUPID here")
    assert plain[0] > 0.9 and dotted[0] == pytest.approx(plain[0], abs=0.05)
    assert "İ now STUPID here"[dotted[2][0] : dotted[3][0]] == "STUPID"
    assert words_of("İSTANBUL Ok") == ["İSTANBUL".lower(), "ok"]


def test_marginals_equal_a_walk_over_every_word(spark):
    import numpy as np

    texts = [(1, f"{spoken(k, k % 9)} STUPID {spoken(k, 20)} clown") for k in range(40)] + [(0, spoken(k, 25)) for k in range(100, 220)]
    tagger = ToxicTagger(spark.createDataFrame(texts, "label int, text string"))
    words = words_of(f"clown {spoken(5, 700)} stupid {spoken(6, 3)} clown stupid {spoken(7, 40)}")
    emit = [np.array([1.0, tagger.weights.get(w, tagger.background)]) for w in words]
    ahead, behind = [tagger.start * emit[0]], [np.ones(2)]
    for e in emit[1:]:
        v = (ahead[-1] / ahead[-1].sum()) @ tagger.move * e
        ahead.append(v)
    for e in emit[:0:-1]:
        v = tagger.move @ (e * behind[-1])
        behind.append(v / v.sum())
    both = [a * b for a, b in zip(ahead, behind[::-1])]
    expected = {i: both[i][1] / both[i].sum() for i, w in enumerate(words) if w in tagger.weights}
    assert dict(tagger.marginals(words)) == pytest.approx(expected, rel=1e-9)
    assert len(expected) == 4
