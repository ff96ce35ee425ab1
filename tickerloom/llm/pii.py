"""Personal data: base patterns, and a linear-chain CRF over word-shape features that adds spans.

The CRF is trained on the small labelled table below and decodes the lines of a text by Viterbi in
numpy batches. Every line is decoded: a word's scores for itself and its neighbours are computed
once per shape of a word. A line is one chain, whatever its length; it is decoded in parts between
words whose tag no neighbour can change, which gives the whole chain's best path. A decoded span is added where it overlaps no base span.

Defined cases: null text is empty text; texts without findings give zero counts and an
empty span list; offsets count code points; rows with a null doc_id or repeated rows are kept as they are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickerloom.llm.common import ship
from tickerloom.llm.crf import Crf, padded

KINDS = ("email", "ip", "card", "phone")
BATCH_ROWS = 256
BLOCK_WORDS = 150_000
KNOWN_WORDS = 1 << 17

LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
# A local part, "at", and labels joined by dots or the word for it; both words bare or in brackets.
WRITTEN_OUT = re.compile(
    r"(?i)(?<![\w.%+-])[\w.%+-]++(?:\s+at\s+|\s*[(\[{<]\s*at\s*[)\]}>]\s*)[\w-]+(?:(?:\.|\s+dot\s+|\s*[(\[{<]\s*dot\s*[)\]}>]\s*)[\w-]+)+"
)
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


class Span(NamedTuple):
    start: int
    kind: int
    end: int


def emails(text: str) -> list[Span]:
    """Leftmost matches found from each `@`, so that long runs without one cost nothing."""
    found, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in LOCAL_CHARS:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append(Span(start, 0, domain.end()))
            free = domain.end()
        else:
            free = max(free, start if start == at else at)
        at = text.find("@", max(at + 1, free))
    return found


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def base_spans(text: str) -> list[Span]:
    found = emails(text) if "@" in text else []
    if "." in text:
        found += [
            Span(m.start(), 1, m.end())
            for m in IP.finditer(text)
            if all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m.group().split("."))
        ]
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                found.append(Span(m.start(), 2, m.end()))
    if "+" in text:
        found += [
            Span(m.start(), 3, m.end())
            for m in PHONE.finditer(text)
            if 10 <= sum(map(str.isdigit, m.group())) <= 15
        ]
    return sorted(found)


# Labelled lines: kind{words}. Words outside braces are no personal data.
LABELLED = """
write to email{anna.berg(at)mail.example} for help
contact email{joe [at] corp [dot] example} today
mail email{lee.k AT firm.example} or call
reach me at email{m_lopez@localhost} please
her address email{kim@intranet} is old
send it to email{info (at) shop (dot) example} soon
call phone{555-123-4567} after noon
phone phone{(555) 123-4567} or write
tel phone{030 1234 5678} in the office
ring phone{0044 20 7946 0958} at night
fax phone{555.123.4567} on weekdays
mobile phone{07700 900123} is mine
telephone phone{(030) 901820} works
call me on phone{212 555 0187} now
host ip{2001:db8::8a2e:370:7334} answers
server ip{fe80::1ff:fe23:4567:890a} is down
address ip{2001:0db8:85a3::7334} was logged
card card{4111.1111.1111.1111} expires soon
pay with card{5500/0000/0000/0004} instead
visa card{4012_8888_8888_1881} on file
in 1998 there were 250 of them
the year 2024 and 17 pages
chapter 12 section 3.4 line 56
it costs 1,299.00 or 45.50 in all
version 2.10.4 of the tool
order 4785380592391139 was sent
number 1234567890123 is an id
key 24be64439e3e49cf46b2d7c90f3602a3d0b907ff is set
token = "9f86d081884c7d659a2feaa0c55ad015"
on 2024-01-31 at 10:45 they met
from 12/05/2021 to 13/06/2022
width 1920x1080 depth 24
see https://example.org/a/123?b=4 for more
room 101 floor 3 house 22
about 3 000 000 people and 40 000 cars
scores 10 20 30 40 50 60
is 99.5 percent of 1000
id=77 name=4x and a1b2c3
follow @someone and @others today
ratio 16:9 and time 12:30:45
article 5 of law 1990 part 7
a 100 b 2000 c 30000
sum 12345678 total 987654321
page=2&ref=x item 900001
"""
TOKEN = re.compile(r"\S+")
LOWER = "abcdefghijklmnopqrstuvwxyz"
MARKED = re.compile(r"(\w+)\{([^}]*)\}|(\S+)")
# One character for all of its class, as in `shape`.
LIKE = {ord(c): like for chars, like in ((LOWER, "a"), (LOWER.upper(), "A"), ("0123456789", "9")) for c in chars}
CUES = re.compile(r"(?i)^\W*(call|phone|tel|telephone|mobile|fax|ring|mail|email|e-mail|contact|card|visa|host|server|address|reach)\W*$")


def shape(word: str) -> str:
    runs = re.sub(r"[A-Z]+", "A", re.sub(r"[a-z]+", "a", word))
    return re.sub(r"[^\x00-\x7f]+", "u", re.sub(r"[0-9]", "9", runs))


@lru_cache(maxsize=4096)
def word_features(word: str) -> tuple[str, ...]:
    """Shape, coarse shape, digits, marks and cue of a word."""
    core = word.strip(".,;:!?\"'")
    digits = sum(c.isdigit() for c in core)
    marks = "".join(sorted(set(re.sub(r"[\w\s]", "", core))))[:6]
    form = shape(core)[:24]
    return (
        f"form={form}",
        f"coarse={re.sub(r'9+', '9', form)[:16]}",
        f"digits={min(digits, 16)}",
        f"marks={marks}",
        f"cue={bool(CUES.match(word))}" if CUES.match(word) else "cue=",
        f"hex={bool(re.fullmatch(r'[0-9a-fA-F:]{6,}', core)) and ':' in core}",
    )


def line_features(words: list[str]) -> list[list[str]]:
    own = [word_features(word) for word in words]
    empty = ("edge",)
    rows = []
    for i, features in enumerate(own):
        before = own[i - 1] if i else empty
        after = own[i + 1] if i + 1 < len(own) else empty
        rows.append(
            ["bias", *features, *(f"-1 {f}" for f in before[:3] + before[4:5]), *(f"+1 {f}" for f in after[:3])]
        )
    return rows


@lru_cache(maxsize=1)
def trained() -> tuple[dict[str, int], Crf]:
    """Feature numbers and the CRF fitted to the labelled table. Tag 0 is no personal data."""
    lines, tags = [], []
    for line in LABELLED.strip().splitlines():
        words, marks = [], []
        for kind, inside, word in MARKED.findall(line):
            for each in (inside.split() if kind else [word]):
                words.append(each)
                marks.append(1 + KINDS.index(kind) if kind else 0)
        lines.append(line_features(words))
        tags.append(marks)
    numbers: dict[str, int] = {}
    coded = [[[numbers.setdefault(f, len(numbers) + 1) for f in features] for features in line] for line in lines]
    features, mask = padded(coded, max(len(f) for line in coded for f in line))
    gold = np.zeros(mask.shape, dtype=np.int64)
    for row, marks in enumerate(tags):
        gold[row, : len(marks)] = marks
    return numbers, Crf(len(numbers) + 1, 1 + len(KINDS)).fit(features, mask, gold, rounds=150, penalty=0.05)


def plausible(kind: int, text: str) -> bool:
    """The digits and marks a span of the kind cannot do without."""
    digits = sum(c.isdigit() for c in text)
    if kind == 0:
        return "@" in text or bool(WRITTEN_OUT.fullmatch(text))
    if kind == 1:
        return text.count(":") >= 2 and bool(re.fullmatch(r"[0-9a-fA-F:.]+", text))
    if kind == 2:
        plain = re.sub(r"\D", "", text)
        return 14 <= digits <= 19 and luhn(plain)
    return 9 <= digits <= 15 and bool(re.search(r"[0-9)][ .-]+[0-9(]", text))


@lru_cache(maxsize=1024)
def feature_scores(word: str | None) -> np.ndarray:
    """Tag scores a word's features give itself, the word after it and the word before it; None is a line's edge."""
    numbers, model = trained()
    own = word_features(word) if word is not None else ()
    before, after = (own[:3] + own[4:5], own[:3]) if own else (("edge",), ("edge",))
    parts = (("bias", *own), [f"-1 {f}" for f in before], [f"+1 {f}" for f in after])
    return np.concatenate([model.unary[[numbers.get(f, 0) for f in part]].sum(axis=0) for part in parts])


def score_form(word: str) -> str:
    """A word with the same `feature_scores`: but for cues and hex words, which letters and digits a word has does not matter."""
    return word if ":" in word or CUES.match(word) else word.translate(LIKE)


class Vocabulary(dict):
    """Words to rows of a table of `feature_scores`, kept from batch to batch; forgotten as a whole when it is full."""

    def __init__(self):
        super().__init__()
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.forms: dict[str, int] = {}
        self.table = np.zeros((1024, 3 * len(trained()[1].first)))

    def __missing__(self, word: str) -> int:
        form = score_form(word)
        row = self.forms.get(form)
        if row is None:
            row = self.forms[form] = len(self.forms)
            if row == len(self.table):
                self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.table[row] = feature_scores(form)
        self[word] = row
        return row


@lru_cache(maxsize=1)
def vocabulary() -> Vocabulary:
    return Vocabulary()


def line_tags(words: list[str], lengths: list[int]) -> np.ndarray:
    """The tag of every word; `lengths` are the numbers of words of the lines."""
    model = trained()[1]
    n, n_tags = len(words), len(model.first)
    known = vocabulary()
    if len(known) > KNOWN_WORDS:
        known.forget()
    codes = np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=n)
    own, after, before = np.split(known.table[: len(known.forms)], 3, axis=1)
    edge = feature_scores(None)
    ends = np.cumsum(lengths)
    first, last = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    first[ends - lengths], last[ends - 1] = True, True
    emission = own[codes]
    emission += np.where(first[:, None], edge[n_tags : 2 * n_tags], after[np.roll(codes, 1)])
    emission += np.where(last[:, None], edge[2 * n_tags :], before[np.roll(codes, -1)])
    tags = np.zeros(n, dtype=np.int16)
    # A word whose lead of tag 0 no neighbours' tags can turn is 0 on the best path, and the chain falls apart there.
    left = np.maximum((model.pair - model.pair[:, :1]).max(axis=0), model.first - model.first[0])
    right = np.maximum((model.pair - model.pair[:1]).max(axis=1), 0.0)
    unsure = (emission - emission[:, :1] + left + right)[:, 1:].max(axis=1) >= -1e-6
    begin = np.flatnonzero(unsure & (first | ~np.roll(unsure, 1)))
    end = np.flatnonzero(unsure & (last | ~np.roll(unsure, -1))) + 1
    order = np.argsort(end - begin, kind="stable")
    begin, end = begin[order], end[order]
    at = 0
    while at < len(begin):
        # Chains of like length share a batch of bounded size; the longest is the batch's last.
        upto = at + max(1, int(np.searchsorted((end - begin)[at : at + 4096] * np.arange(1, len(begin[at : at + 4096]) + 1), BLOCK_WORDS)))
        a, z = begin[at:upto], end[at:upto]
        index = a[:, None] + np.arange((z - a).max())
        mask = index < z[:, None]
        start_scores = np.where(first[a, None], model.first, model.pair[0])
        end_scores = np.where(last[z - 1, None], 0.0, model.pair[:, 0])
        best = model.decode_rising(emission[np.minimum(index, n - 1)], z - a, start_scores, end_scores)
        tags[index[mask]] = best[mask]
        at = upto
    return tags


def crf_spans(texts: list[str]) -> list[list[Span]]:
    """Spans the CRF decodes in each text."""
    found: list[list[Span]] = [[] for _ in texts]
    lines: list[tuple[int, int, str]] = []
    words: list[str] = []
    lengths: list[int] = []
    for number, text in enumerate(texts):
        start = 0
        for line in text.split("\n"):
            inside = line.split()
            if inside:
                lines.append((number, start, line))
                lengths.append(len(inside))
                words += inside
            start += len(line) + 1
        if words and (len(words) >= BLOCK_WORDS or number + 1 == len(texts)):
            tags, ends = line_tags(words, lengths), np.cumsum(lengths)
            for i in np.unique(np.searchsorted(ends, np.flatnonzero(tags), side="right")).tolist():
                number_, at, line = lines[i]
                places = [(at + m.start(), at + m.end()) for m in TOKEN.finditer(line)]
                found[number_] += tagged_spans(texts[number_], places, tags[ends[i] - lengths[i] : ends[i]])
            lines, words, lengths = [], [], []
    return found


def tagged_spans(text: str, places: list[tuple[int, int]], best: np.ndarray) -> list[Span]:
    """Plausible spans of the runs of equal tags; of a run tagged email without `@`, the addresses written out in it."""
    found, i = [], 0
    while i < len(places):
        tag, j = int(best[i]), i
        while j < len(places) and best[j] == tag:
            j += 1
        if tag:
            a, b = places[i][0], places[j - 1][1]
            inner = text[a:b]
            if tag == 1 and "@" not in inner:
                found += [Span(a + m.start(), 0, a + m.end()) for m in WRITTEN_OUT.finditer(inner)]
            else:
                a, b = a + len(inner) - len(inner.lstrip(".,;:!?\"'")), b - (len(inner) - len(inner.rstrip(".,;:!?\"'")))
                if a < b and plausible(tag - 1, text[a:b]):
                    found.append(Span(a, tag - 1, b))
        i = j
    return found


def all_spans(texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans, and all spans, of each text in order."""
    results = []
    for text, more in zip(texts, crf_spans(texts)):
        base = base_spans(text)
        free = [s for s in more if not any(s.start < b.end and b.start < s.end for b in base)]
        results.append((base, sorted([*base, *free])))
    return results


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[s.kind]}:{s.start}:{s.end}" for s in spans)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each span, overlapping ones merged, replaced by the first one's kind in angle brackets."""
    parts, at = [], 0
    for span in spans:
        if span.start >= at:
            parts += [text[at : span.start], f"<{KINDS[span.kind].upper()}>"]
        at = max(at, span.end)
    return "".join([*parts, text[at:]])


ADDED = "n_email long, n_ip long, n_card long, n_phone long, base_spans string, spans string, clean_text string"


def find_personal_data(docs: DataFrame) -> DataFrame:
    """`docs` with base counts per kind, `base_spans`, `spans` and `clean_text` (spans replaced)."""
    ship(docs.sparkSession)
    new = [part.split()[0] for part in ADDED.split(", ")]
    rest = [name for name in docs.columns if name not in new]
    # All columns travel as one struct, the text among them, so that no name can clash and no text goes twice.
    place = rest.index("text")
    narrow = docs.withColumn("text", F.col("text").cast("string")).select(F.struct(*rest).alias("row"))
    schema = narrow.select("row", *[F.lit(None).cast(p.split()[1]).alias(p.split()[0]) for p in ADDED.split(", ")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = [t or "" for t in part.column(0).field(place).to_pylist()]
                spans = all_spans(texts)
                counts = [pa.array([sum(s.kind == k for s in base) for base, _ in spans], pa.int64()) for k in range(4)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), *counts,
                        pa.array([listed(base) for base, _ in spans], pa.string()),
                        pa.array([listed(every) for _, every in spans], pa.string()),
                        pa.array([redacted(t, every) for t, (_, every) in zip(texts, spans)], pa.string()),
                    ],
                    names=["row", *new],
                )
        # The worker goes on to other stages: it need not keep this one's words.
        vocabulary().forget()

    found = narrow.mapInArrow(run, schema)
    return found.select(*[F.col("row").getField(name).alias(name) for name in rest], *new)
