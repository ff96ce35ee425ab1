"""Benchmark passages behind stems of sibling questions, in other layouts and with other names."""

import pytest

from tickerloom.llm.template_leaks import leaks

ITEM = "a train drives 120 km in 3 hours and then stops for 20 minutes so how far does it go"
STEM = "a train drives 45 km in 7 cars"


def found(spark, text, item=ITEM):
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    rows = leaks(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    return [(r.cover >= 0.8, r.agree, r.exact) for r in rows]


def test_a_verbatim_passage_behind_a_stem_with_other_values(spark):
    assert found(spark, f"{STEM} or {ITEM} at last") == [(True, 1.0, True)]
    assert found(spark, f"{STEM} or {STEM} or {ITEM} or {STEM}") == [(True, 1.0, True)]


def test_a_passage_with_other_values_behind_a_stem(spark):
    other = ITEM.replace("120", "250").replace("3 hours", "5 hours").replace("20 m", "45 m")
    assert found(spark, f"{STEM} or {other} at last") == [(True, 1.0, False)]


def test_a_stem_alone_is_no_leak(spark):
    assert found(spark, f"{STEM} or {STEM} at last") == []


NAMED = "then Tom has 5 apples and goes home. Tom gives 3 of them to Mary Ann in Paris and eats the rest there. How many are left"


@pytest.mark.parametrize(
    "text",
    [
        NAMED.replace(" ", "\n"),
        NAMED.replace(" ", "  "),
        NAMED.replace(" Tom", "\r\n\tTom").replace(" Paris", "\n\u00a0Paris"),
        NAMED.lower(),
        NAMED.upper(),
    ],
)
def test_verbatim_passages_in_another_layout_or_case(spark, text):
    assert found(spark, f"so {text} now", NAMED) == [(True, 1.0, True)]


def test_names_at_the_start_of_sentences_and_of_other_lengths(spark):
    other = NAMED.replace("Tom", "Anna").replace("Paris", "New York").replace("5", "9").replace("Mary Ann", "Bob")
    assert found(spark, f"so {other} now", NAMED) == [(True, 1.0, False)]


def test_number_words_digits_and_units_are_slots(spark):
    item = "a farmer fills three litres of milk into 12 jugs and sells each jug for five dollars at the market so how much"
    same = item.replace("three litres", "7 gallons").replace("12", "nineteen").replace("five dollars", "8 euros")
    assert found(spark, f"so {same} is it", item) == [(True, 1.0, False)]
    # A unit is one only behind a number.
    assert found(spark, f"so {item.replace('three litres', 'many litres')} is it", item.replace("three litres", "many gallons")) == []


TWICE = "Tom walks to the old mill before noon and then slowly Tom walks home again in the rain"


def test_the_first_name_is_a_slot(spark):
    assert found(spark, f"so {TWICE.replace('Tom', 'Maria')} now", TWICE) == [(True, 1.0, False)]
    assert found(spark, f"Then {TWICE.replace('Tom', 'Maria')} now", TWICE) == [(True, 1.0, False)]
    other = TWICE.replace("Tom walks to", "Maria walks to").replace("slowly Tom", "slowly Susan")
    assert found(spark, f"so {other} now", TWICE) == []


def test_items_of_all_sizes_in_one_pass(spark):
    docs = spark.createDataFrame([(1, "red apples fall"), (2, "we saw red apples fall far"), (3, "green pears")], "doc_id long, text string")
    items = [(1, "red apples"), (2, "red apples fall"), (3, "green"), (4, "we saw red apples fall far away")]
    got = leaks(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, 1), (1, 2), (2, 1), (2, 2), (3, 3)}
