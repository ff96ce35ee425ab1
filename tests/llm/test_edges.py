"""Nulls, empty and long texts, repeated rows, empty tables and clashing columns."""

import public_tokenizers
import pytest

from tickerloom.llm.common import new_folder
from tickerloom.llm.pieces import decode_documents, encode_documents
from tickerloom.llm.pii import find_personal_data
from tickerloom.llm.quality_lines import clean_lines
from tickerloom.llm.simhash import near_duplicates
from tickerloom.llm.statistics_qda import score_quality
from tickerloom.llm.template_leaks import leaks
from tickerloom.llm.token_files import read_token_files, write_token_files
from tickerloom.llm.toxic_spans import score_toxicity
from tickerloom.llm.url_cascade import judge_urls
from tickerloom.llm.warc import read_warc, write_warc

LONG = "word " * 4000 + "x" * 5000
ROWS = [(1, None, "a"), (2, "", "b"), (None, "some words here", None), (3, "some words here", "c"), (3, "some words here", "c"), (4, LONG, "d")]
SCHEMA = "doc_id long, text string, kept string"
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def labels(spark):
    return spark.createDataFrame([(1, None, 0), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")


def token_rows(docs):
    folder = new_folder(docs.sparkSession, "edge")
    return read_token_files(write_token_files(docs, WORDS, folder, 1), folder)


OPERATORS = {
    "quality": lambda s, d: score_quality(d, labels(s)),
    "toxicity": lambda s, d: score_toxicity(d, labels(s)),
    "personal": lambda s, d: find_personal_data(d),
    "pieces": lambda s, d: decode_documents(encode_documents(d, PIECES), PIECES),
    "lines": lambda s, d: clean_lines(d),
    "simhash": lambda s, d: near_duplicates(d),
    "tokens": lambda s, d: token_rows(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_every_row_has_a_result(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame(ROWS, SCHEMA)).count() == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_gives_no_rows(spark, name):
    assert OPERATORS[name](spark, spark.createDataFrame([], SCHEMA)).count() == 0


def test_leaks_of_odd_items(spark):
    passage = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, passage), (2, None), (3, ""), (None, passage), (4, "two words")], "item_id long, text string")
    docs = spark.createDataFrame([(1, f"so {passage} end"), (2, None), (None, passage), (3, "other")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in leaks(docs, items).collect()] == [(1, 1)]
    assert leaks(docs.limit(0), items).count() == 0
    assert leaks(docs, items.limit(0)).count() == 0


def test_leaks_see_other_numbers_in_the_template(spark):
    items = spark.createDataFrame([(1, "a train drives 120 km in 3 hours and then stops for 20 minutes here")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "now a train drives 250 km in 5 hours and then stops for 45 minutes here")], "doc_id long, text string")
    row = leaks(docs, items).first()
    assert (row.doc_id, row.item_id, row.exact) == (1, 1, False)


def test_urls_without_host(spark):
    rules = spark.createDataFrame([("com", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, None, "x"), (2, "no host", "y"), (3, "http://A.com/p?q", "z")], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in judge_urls(pages, rules).collect()}
    assert got == {1: ("", "", None, "allow"), 2: ("", "", None, "allow"), 3: ("a.com", "/p", "com/", "block")}
    assert judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == 3
    assert judge_urls(pages.limit(0), rules).count() == 0


def test_warc_of_odd_pages(spark):
    rows = [(1, None, None), (2, "u\r\nv", ""), (None, "n", "same"), (3, "a", "same"), (4, "b", "same"), (4, "b", "same")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = new_folder(spark, "warc")
    got = sorted((r.page_id or 0, r.record_type, r.refers_to) for r in read_warc(write_warc(pages, folder), folder).collect())
    assert got == sorted([(1, "response", None), (2, "revisit", 1), (0, "response", None), (3, "response", None), (4, "revisit", 3), (4, "revisit", 3)], key=lambda r: (r[0], r[1], r[2] or 0))
    folder = new_folder(spark, "warc")
    assert read_warc(write_warc(pages.limit(0), folder), folder).count() == 0
