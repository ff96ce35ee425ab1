"""The CRF of the personal data operator against plain decoding of whole lines."""

import random

import pytest

from tickerloom.llm.crf import padded
from tickerloom.llm.pii import LABELLED, MARKED, TOKEN, crf_spans, line_features, tagged_spans, trained


def plain_spans(text):
    """Every line decoded as one chain from its feature lists."""
    numbers, model = trained()
    found, start = [], 0
    for line in text.split("\n"):
        places = [(start + m.start(), start + m.end()) for m in TOKEN.finditer(line)]
        if places:
            coded = [[numbers.get(f, 0) for f in fs] for fs in line_features([text[a:b] for a, b in places])]
            features, mask = padded([coded], 16)
            found += tagged_spans(text, places, model.decode(model.emissions(features), mask)[0])
        start += len(line) + 1
    return found


@pytest.mark.parametrize(
    "address", ["anna.berg(at)mail.example", "joe [at] corp [dot] example", "info (at) shop (dot) example"]
)
def test_written_out_addresses_in_lines_without_digits(address):
    text = f"some words\nwrite to {address} for help\nmore words"
    assert [(text[s.start : s.end], s.kind) for s in crf_spans([text])[0]] == [(address, 0)]


def test_short_lines_equal_plain_decoding():
    draw = random.Random(5)
    plain = [" ".join(w or inside for _, inside, w in MARKED.findall(line)) for line in LABELLED.strip().splitlines()]
    words = " ".join(plain).split()
    texts = [*plain, "", "\n\n", "\n".join(" ".join(draw.choices(words, k=draw.randint(1, 60))) for _ in range(200))]
    assert crf_spans(texts) == [plain_spans(t) for t in texts]


@pytest.mark.parametrize("before", range(55, 66))
def test_spans_anywhere_in_a_long_line(before):
    text = " ".join(["word"] * before) + " call phone (030) 1234 5678 in the office " + " ".join(["word"] * 90)
    assert ["(030) 1234 5678"] == [text[s.start : s.end] for s in crf_spans([text])[0]]
    assert crf_spans([text])[0] == plain_spans(text)


def test_long_lines_equal_plain_decoding():
    draw = random.Random(6)
    words = [w for line in LABELLED.strip().splitlines() for _, inside, w in MARKED.findall(line) for w in (w or inside).split()]
    texts = ["\n".join(" ".join(draw.choices(words, k=draw.randint(65, 900))) for _ in range(6)) for _ in range(8)]
    assert crf_spans(texts) == [plain_spans(t) for t in texts]
