"""Toxicity: a linear-chain CRF tags toxic words; marginals give document scores and offsets.

Token labels come from the labelled documents: a word is labelled toxic in a toxic
document if it is far more frequent in toxic training texts than in others and its own
counts would be rare by chance: the Chernoff bound of its toxic count passes Benjamini and
Hochberg's rule over all words tested, with a share of FALSE_SHARE expected to be wrong. Word counts cover all distinct training texts, copies count
once, and so do places of a word among the same four neighbours (edited copies). The CRF is trained on all stretches with candidate words in a bounded sample of whole distinct labelled
texts (SAMPLE_DOCUMENTS per class, in hash order). Its features are a bias, the
identity of candidate words (high odds, chance at most CANDIDATE_CHANCE) and one that all
words labelled toxic share, so that rare ones outside the sample have its weight. All other words share
one emission, so forward-backward runs over every word of a text, but takes a run of such words as one power of
their transition matrix. The document score is a logistic, fitted on the sample, of the
largest marginal's log odds.

Defined cases: null text is empty text; a text without words gets the score of log odds
at the floor; without toxic labels every score is the floor's; repeated rows are scored each.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tickerloom.llm.common import is_held_out, labels_by_document, ship, stored
from tickerloom.llm.crf import Crf, padded

WORD = re.compile(r"[^\W\d_]+")
BATCH_ROWS = 256
SAMPLE_DOCUMENTS = 1500
WINDOW_WORDS = 16
MIN_DOCUMENTS = 3
MIN_ODDS = 3.0
FALSE_SHARE = 0.01
CANDIDATE_CHANCE = 1.0
ROUNDS, PENALTY = 80, 0.02
FLOOR = 1e-7


def words_of(text: str) -> list[str]:
    """Lower-cased words. Each word is lowered by itself, as some letters lower to several code points."""
    if text.isascii():
        return WORD.findall(text.lower())
    return [word.lower() for word in WORD.findall(text)]


def _document_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH_ROWS):
            part = batch.slice(at, BATCH_ROWS)
            words = [sorted(set(words_of(t or ""))) for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(words, pa.list_(pa.string()))], names=["label", "words"])


def _places_of(wanted: set[str]):
    """The first place of each wanted word in each text: a hash of the two words before and after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = words_of(text or "")
                seen = set()
                for i, word in enumerate(words):
                    if word in wanted and word not in seen:
                        seen.add(word)
                        around = " ".join([*words[max(0, i - 2) : i], "", *words[i + 1 : i + 3]])
                        rows.append((label, word, xxhash.xxh64_intdigest(around.encode()) >> 1))
            columns = list(zip(*rows)) or [[], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.string()), pa.array(columns[2], pa.int64())],
                names=["label", "word", "place"],
            )

    return run


def candidate_words(texts: DataFrame) -> dict[str, bool]:
    """Words of distinct labelled texts with significantly high log odds -> whether they are labelled toxic."""
    sizes = {row["label"]: row["count"] for row in texts.groupBy("label").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return {}
    words = texts.select("label", "text").mapInArrow(_document_words, "label int, words array<string>")
    counts = stored(
        words.select("label", F.explode("words").alias("word"))
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
        .where(F.col("toxic") >= MIN_DOCUMENTS),
        "toxicwords",
    )
    tested = counts.count()
    if not tested:
        return {}
    base = sizes[1] / (sizes[0] + sizes[1])

    def significant(counts: DataFrame) -> DataFrame:
        odds = F.log((F.col("toxic") + 0.5) / (sizes[1] + 1.0)) - F.log((F.col("n") - F.col("toxic") + 0.5) / (sizes[0] + 1.0))
        share = F.col("toxic") / F.col("n")
        clean = F.when(share < 1, (1 - share) * F.log((1 - share) / (1 - base))).otherwise(0.0)
        surprise = F.when(share > base, F.col("n") * (share * F.log(share / base) + clean)).otherwise(0.0)
        marked = counts.where(odds >= MIN_ODDS).select("word", (surprise - math.log(tested)).alias("lead"))
        return marked.where(F.col("lead") >= -math.log(CANDIDATE_CHANCE))

    # Edited copies of one text repeat a word among the same neighbours: such places count once.
    first = {row["word"] for row in significant(counts).collect()}
    places = texts.select("label", "text").mapInArrow(_places_of(first), "label int, word string, place long").distinct()
    rows = significant(places.groupBy("word").agg(F.sum("label").alias("toxic"), F.count("*").alias("n"))
                       .where(F.col("toxic") >= MIN_DOCUMENTS)).collect()
    # Benjamini and Hochberg's step-up rule over all words tested: the k-th most significant word counts
    # if its chance, times the words tested, is at most k times the share of false ones allowed.
    ranked = sorted(rows, key=lambda row: (-row["lead"], row["word"]))
    labelled = max((k for k, row in enumerate(ranked, 1) if -row["lead"] <= math.log(FALSE_SHARE * k)), default=0)
    toxic = {row["word"] for row in ranked[:labelled]}
    return {row["word"]: row["word"] in toxic for row in sorted(rows)}


class ToxicTagger:
    """`labelled` has columns label and text; `distinct` says that it holds each pair once."""

    def __init__(self, labelled: DataFrame, distinct: bool = False):
        texts = labelled.select("label", "text")
        texts = stored(texts if distinct else texts.distinct(), "toxictexts")
        self.candidates = candidate_words(texts)
        self.numbers = {word: 3 + i for i, word in enumerate(self.candidates)}
        self.slope, self.shift = 1.0, 0.0
        self.weights, self.background = {}, 1e-9
        self.move, self.start = np.array([[1.0, 1e-9], [1.0, 1e-9]]), np.array([1.0, 1e-9])
        if any(self.candidates.values()):
            self.train(self.sample(texts))

    @staticmethod
    def sample(texts: DataFrame) -> list[tuple[int, list[str]]]:
        """Label and words of whole texts, at most SAMPLE_DOCUMENTS per class."""
        found = []
        sizes = {row["label"]: row["count"] for row in texts.groupBy("label").count().collect()}
        place = F.shiftrightunsigned(F.xxhash64("text"), 11) / float(1 << 53)
        for label, size in sorted(sizes.items()):
            own = texts.where(F.col("label") == label).withColumn("place", place)
            # The first texts in hash order lie below a share of the hashes; only they leave their tasks.
            share, rows = 1.25 * (SAMPLE_DOCUMENTS + 50) / size, []
            while len(rows) < min(SAMPLE_DOCUMENTS, size):
                rows = own.where(F.col("place") < share).select("place", "text").collect()
                share *= 2
            first = sorted((row["place"], row["text"] or "") for row in rows)[:SAMPLE_DOCUMENTS]
            found += [(label, words_of(text)) for _, text in first]
        return found

    def train(self, documents: list[tuple[int, list[str]]]) -> None:
        features, tags = [], []
        for label, words in documents:
            # Every stretch of WINDOW_WORDS words with a candidate, in texts of both classes. All other words are
            # alike to the model, so a text without candidates is told by one stretch.
            held = sorted({i // WINDOW_WORDS for i, w in enumerate(words) if w in self.candidates})
            for block in held or [len(words) // 2 // WINDOW_WORDS]:
                part = words[block * WINDOW_WORDS : (block + 1) * WINDOW_WORDS]
                if part:
                    features.append([[1, 2 * bool(self.candidates.get(w)), self.numbers.get(w, 0)] for w in part])
                    tags.append([int(bool(label and self.candidates.get(w))) for w in part])
        coded, mask = padded(features, 3)
        gold = np.zeros(mask.shape, dtype=np.int64)
        for row, marks in enumerate(tags):
            gold[row, : len(marks)] = marks
        crf = Crf(3 + len(self.numbers), 2).fit(coded, mask, gold, ROUNDS, PENALTY)
        odds = np.exp(np.clip(crf.unary[:, 1] - crf.unary[:, 0], -30, 30))
        self.weights = {w: float(odds[1] * odds[2] ** self.candidates[w] * odds[i]) for w, i in self.numbers.items()}
        self.background = float(odds[1])
        self.move, self.start = np.exp(crf.pair - crf.pair.max()), np.exp(crf.first - crf.first.max())
        self.calibrate(documents)

    def calibrate(self, documents: list[tuple[int, list[str]]]) -> None:
        """Logistic regression of the document label on the largest log odds, by Newton steps."""
        odds = np.array([self.log_odds(max((p for _, p in self.marginals(words)), default=0.0)) for _, words in documents])
        label = np.array([label for label, _ in documents], dtype=float)
        middle = odds.mean()
        design = np.stack([np.ones_like(odds), odds - middle], axis=1)
        weights = np.zeros(2)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
            hessian = (design * (p * (1 - p) + 1e-6)[:, None]).T @ design + 1e-2 * np.eye(2)
            weights = weights + np.linalg.solve(hessian, design.T @ (label - p) - 1e-2 * weights)
        self.slope, self.shift = float(weights[1]), float(weights[0] - weights[1] * middle)

    @staticmethod
    def log_odds(p: float) -> float:
        p = min(max(p, FLOOR), 1 - FLOOR)
        return float(np.log(p) - np.log1p(-p))

    def run_of(self, length: int) -> np.ndarray:
        """The transition over `length` words without weight, up to a factor."""
        step = self.move * np.array([1.0, self.background])
        # Repeated squaring, scaled at every step: no length leaves the range of doubles.
        total, step = np.eye(2), step / step.max()
        while length:
            if length & 1:
                total = total @ step
                total = total / total.max()
            step = step @ step
            step, length = step / step.max(), length >> 1
        return total

    def marginals(self, words: list[str]) -> list[tuple[int, float]]:
        """Position and probability of the toxic tag for every candidate word, by forward-backward."""
        weights = self.weights
        places = [i for i, w in enumerate(words) if w in weights]
        if not places:
            return []
        unit = lambda v: v / v.sum()
        ahead, vector, last = [], self.start, -1
        for i in places:
            if last < 0 and i > 0:
                vector = unit((vector * np.array([1.0, self.background])) @ self.run_of(i - 1)) @ self.move
            elif last >= 0:
                vector = unit(vector @ self.run_of(i - last - 1)) @ self.move
            vector = unit(vector * np.array([1.0, weights[words[i]]]))
            ahead.append(vector)
            last = i
        found, after = [], unit(self.run_of(len(words) - 1 - places[-1]) @ np.ones(2))
        for at in range(len(places) - 1, -1, -1):
            both = ahead[at] * after
            found.append((places[at], float(both[1] / both.sum())))
            if at:
                after = self.move @ (np.array([1.0, weights[words[places[at]]]]) * after)
                after = unit(self.run_of(places[at] - places[at - 1] - 1) @ after)
        return found[::-1]

    def score(self, text: str) -> tuple[float, float, list[int], list[int]]:
        """Score, expected toxic words, and the start and end offsets of words with a marginal of a half or more."""
        found = self.marginals(words_of(text))
        top = max((p for _, p in found), default=0.0)
        hits = {i for i, p in found if p >= 0.5}
        places = [m.span() for k, m in enumerate(WORD.finditer(text)) if k in hits] if hits else []
        score = 1 / (1 + np.exp(-np.clip(self.slope * self.log_odds(top) + self.shift, -30, 30)))
        return float(score), float(sum(p for _, p in found)), [a for a, _ in places], [b for _, b in places]


def distinct_labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """label and text of every distinct labelled text, that of the smallest doc_id (rows that repeat id and text stay).

    Which rows those are is found on ids and digests; texts then go through one shuffle, the same at every size.
    """
    text = F.coalesce("text", F.lit(""))
    digests = [F.xxhash64(text).alias("d1"), F.xxhash64(F.lit("second"), text).alias("d2")]
    keys = docs.where("doc_id IS NOT NULL").select("doc_id", *digests).join(labels, "doc_id")
    first = stored(keys.groupBy("label", "d1", "d2").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "label", "d1", "d2"), "toxicfirst")
    marked = docs.select("doc_id", text.alias("text"), *digests)
    return marked.join(first.hint("shuffle_hash"), ["doc_id", "d1", "d2"]).select("label", "text")


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score, predicted, expected_words, starts, ends per row of `docs`."""
    spark = docs.sparkSession
    ship(spark)
    training = labels_by_document(labels, "toxic").where(~is_held_out(F.col("doc_id")))
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    tagger = ToxicTagger(distinct_labelled(narrow, training), distinct=True)
    shared = spark.sparkContext.broadcast(tagger)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                rows = [model.score(t or "") for t in part.column(1).to_pylist()]
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(columns[0], pa.float64()), pa.array(columns[1], pa.float64()),
                     pa.array(columns[2], pa.list_(pa.int32())), pa.array(columns[3], pa.list_(pa.int32()))],
                    names=["doc_id", "score", "expected_words", "starts", "ends"],
                )

    scored = narrow.mapInArrow(run, "doc_id long, score double, expected_words double, starts array<int>, ends array<int>")
    return scored.select(
        "doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), "expected_words", "starts", "ends",
    )
