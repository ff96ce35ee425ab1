"""Periodic runs of words: maximal stretches that repeat with a period, found by block convolution.

Texts of an Arrow batch are laid end to end, with a word of its own between any two, and words
become numbers. At each dyadic scale B the stretch is cut into blocks of B words. Of a run with
period q in the scale's range at least one whole block lies in a place where it occurs again q
words later, so that every run shows itself at its scale: the squared differences between a block
and all alignments in the window that follows it are one convolution, computed exactly with a
number-theoretic transform, and an alignment where they add up to zero is an occurrence. Its distance
is a candidate period; the seed is extended both ways to the maximal stretch with that
period. A stretch found with several periods has the smallest of them: by Fine and Wilf the others
are its multiples.

Only blocks whose every word occurs again within the scale's longest distance are transformed; no
other block can occur again there. Work per text is independent of other texts and of where it
lies in a batch; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tickerloom.llm.common import ship

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LEAST_LENGTH = 12
BATCH_WORDS = 1 << 17
TRANSFORM_CELLS = 1 << 20
# A prime with 2^23 dividing one less than it, and a generator of its units.
PRIME, GENERATOR, LOG_ORDER = 998244353, 3, 23
RUNS = "array<struct<start:long,length:long,period:long>>"


def _mod(values: np.ndarray) -> np.ndarray:
    return values - values // np.uint64(PRIME) * np.uint64(PRIME)


def _roots(size: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of order `size`, half a turn of them."""
    root = pow(GENERATOR, (PRIME - 1) // size, PRIME)
    if inverse:
        root = pow(root, PRIME - 2, PRIME)
    powers = np.ones(max(1, size // 2), dtype=np.uint64)
    have = 1
    while have < len(powers):
        powers[have : 2 * have] = _mod(powers[:have] * np.uint64(pow(root, have, PRIME)))
        have *= 2
    return powers


def transform(rows: np.ndarray, inverse: bool = False) -> np.ndarray:
    """The number-theoretic transform of every row; the inverse takes and divides out the forward order.

    Forward runs decimation in frequency (its output is bit-reversed), inverse decimation in time
    from that order, so that products in between need no reordering.
    """
    n_rows, size = rows.shape
    if size > 1 << LOG_ORDER:
        raise OverflowError("windows beyond the transform's order")
    rows = rows.copy()
    prime = np.uint64(PRIME)
    roots = _roots(size, inverse)
    halves = [1 << k for k in range(size.bit_length() - 1)]
    for half in halves if inverse else reversed(halves):
        turn = roots[:: size // (2 * half)]
        cells = rows.reshape(n_rows, size // (2 * half), 2, half)
        low, high = cells[:, :, 0], cells[:, :, 1]
        if inverse:
            high = _mod(high * turn)
            low, high = low + high, low + prime - high
        else:
            low, high = low + high, _mod((low + prime - high) * turn)
        cells[:, :, 0] = np.where(low >= prime, low - prime, low)
        cells[:, :, 1] = np.where(high >= prime, high - prime, high)
    if inverse:
        rows = _mod(rows * np.uint64(pow(size, PRIME - 2, PRIME)))
    return rows


def scales(longest: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Block size and the ranges of periods [low, high) it serves, for stretches of `longest` words.

    A run of period q repeats on max(LEAST_LENGTH - q, q) words or more; a block fits into any
    place of 2B - 1 words.
    """
    served: dict[int, list[int]] = {}
    for q in range(1, min(LEAST_LENGTH, longest // 2 + 1)):
        size = 1 << ((max(LEAST_LENGTH - q, q) + 1) // 2).bit_length() - 1
        served.setdefault(size, []).append(q)
    result: dict[int, list[tuple[int, int]]] = {}
    for size, periods in served.items():
        cuts = np.flatnonzero(np.diff(periods) > 1) + 1
        result[size] = [(int(part[0]), int(part[-1]) + 1) for part in np.split(np.array(periods), cuts)]
    q = LEAST_LENGTH
    while q <= longest // 2:
        size = 1 << ((q + 1) // 2).bit_length() - 1
        end = min(4 * size - 1, longest // 2 + 1)
        result.setdefault(size, []).append((q, end))
        q = end
    return sorted(result.items())


def _equal_blocks(words: np.ndarray, at: np.ndarray, distance: np.ndarray, size: int) -> np.ndarray:
    same = np.ones(len(at), dtype=bool)
    rows = max(1, TRANSFORM_CELLS // size)
    for part in range(0, len(at), rows):
        places = at[part : part + rows, None] + np.arange(size)
        same[part : part + rows] = (words[places] == words[places + distance[part : part + rows, None]]).all(axis=1)
    return same


def occurrences(
    words: np.ndarray,
    starts: np.ndarray,
    size: int,
    low: int,
    high: int,
    known: Callable[[np.ndarray, np.ndarray], np.ndarray],
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (block start, distance in [low, high)) at which the block occurs again, but for `known` pairs.

    Squared differences are sums of squares, by running totals, less twice the correlation.
    They are exact modulo the prime; the few alignments whose sum is a multiple of it are told
    apart by comparing the words.
    """
    window = high - low + size - 1
    order = 1 << (window - 1).bit_length()
    together = max(1, TRANSFORM_CELLS // order)
    squares = np.concatenate([[0], np.cumsum(words * words % PRIME)])
    found_at, found_distance = [], []
    for at in range(0, len(starts), together):
        blocks = starts[at : at + together]
        pattern = np.zeros((len(blocks), order), dtype=np.uint64)
        text = np.zeros((len(blocks), order), dtype=np.uint64)
        # Reversed about zero, the block's convolution with the window is their correlation.
        pattern[:, (-np.arange(size)) % order] = words[blocks[:, None] + np.arange(size)]
        text[:, :window] = words[blocks[:, None] + low + np.arange(window)]
        correlation = transform(_mod(transform(pattern) * transform(text)), inverse=True)[:, : high - low].astype(np.int64)
        shifted = blocks[:, None] + np.arange(low, high)
        own = squares[blocks + size] - squares[blocks]
        difference = own[:, None] + squares[shifted + size] - squares[shifted] - 2 * correlation
        row, distance = np.nonzero(difference % PRIME == 0)
        where, distance = blocks[row], distance + low
        fresh = ~known(where, distance)
        where, distance = where[fresh], distance[fresh]
        same = _equal_blocks(words, where, distance, size)
        found_at.append(where[same])
        found_distance.append(distance[same])
    if not found_at:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(found_at), np.concatenate(found_distance)


def _matching(words: np.ndarray, at: np.ndarray, distance: np.ndarray, step: int) -> np.ndarray:
    """How many words from `at` on, in direction `step`, equal those `distance` later; looks twice as far each turn."""
    reached = np.zeros(len(at), dtype=np.int64)
    active = np.arange(len(at))
    width = 16
    while len(active):
        again = []
        rows = max(1, TRANSFORM_CELLS // width)
        for part in range(0, len(active), rows):
            these = active[part : part + rows]
            places = at[these, None] + step * (reached[these, None] + np.arange(width))
            inside = (places >= 0) & (places + distance[these, None] < len(words))
            places = np.where(inside, places, 0)
            ahead = np.where(inside, places + distance[these, None], 0)
            unequal = ~inside | (words[places] != words[ahead])
            first = np.where(unequal.any(axis=1), unequal.argmax(axis=1), width)
            reached[these] += first
            again.append(these[first == width])
        active = np.concatenate(again)
        width = min(width * 2, TRANSFORM_CELLS)
    return reached


def _merged(starts: np.ndarray, distances: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, end, distance) of rows of adjoining blocks with one distance."""
    if not len(starts):
        return starts, starts, distances
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (distances[1:] != distances[:-1]) | (starts[1:] != starts[:-1] + size)
    firsts = np.flatnonzero(fresh)
    lasts = np.append(firsts[1:], len(starts)) - 1
    return starts[firsts], starts[lasts] + size, distances[firsts]


def find_runs(words: np.ndarray, longest: int) -> np.ndarray:
    """All runs of a row of word numbers as rows (start, length, period), by start, then period.

    `longest` bounds the stretches that can repeat (the longest text). Words that occur once
    end every stretch; the row must end with one.
    """
    total = len(words)
    order = np.lexsort((np.arange(total), words))
    again = np.full(total, total, dtype=np.int64)
    follows = words[order[1:]] == words[order[:-1]]
    again[order[:-1][follows]] = (order[1:] - order[:-1])[follows]
    # Runs so far, by end: a seed within one whose period divides the seed's distance is that run.
    cover = np.zeros(total, dtype=np.int64)
    cover_period = np.ones(total, dtype=np.int64)
    runs: dict[tuple[int, int], int] = {}
    ranges = sorted((low, high, size) for size, parts in scales(longest) for low, high in parts)
    for low, high, size in ranges:
        n_blocks = total // size
        reach = again[: n_blocks * size].reshape(n_blocks, size).max(axis=1)
        starts = np.flatnonzero(reach < high) * size
        # Behind the row's end lie words that are nowhere else.
        padded = np.concatenate([words, total + np.arange(high + size)])

        def known(at: np.ndarray, distance: np.ndarray, size: int = size) -> np.ndarray:
            return (cover[at] >= at + distance + size) & (distance % cover_period[at] == 0)

        begin, end, distance = _merged(*occurrences(padded, starts, size, low, high, known), size)
        left = begin - _matching(words, begin - 1, distance, -1)
        right = end + _matching(words, end, distance, 1) + distance
        whole = right - left >= np.maximum(LEAST_LENGTH, 2 * distance)
        for s, e, q in zip(left[whole].tolist(), right[whole].tolist(), distance[whole].tolist()):
            if runs.get((s, e), q + 1) > q:
                runs[s, e] = q
                longer = cover[s:e] < e
                cover[s:e][longer] = e
                cover_period[s:e][longer] = q
    found = np.array([(s, e - s, q) for (s, e), q in runs.items()], dtype=np.int64).reshape(-1, 3)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of_texts(texts: list[list[str]]) -> list[np.ndarray]:
    """The runs of each text, given its words."""
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    numbers: dict[str | int, int] = defaultdict(count().__next__)
    flat: list[int] = []
    for words in texts:
        flat.extend(map(numbers.__getitem__, words))
        # A word that no text holds.
        flat.append(numbers[len(flat)])
    begins = np.cumsum(lengths + 1) - lengths - 1
    found = find_runs(np.array(flat, dtype=np.int64), int(lengths.max(initial=0)))
    owner = np.searchsorted(begins, found[:, 0], side="right") - 1
    found[:, 0] -= begins[owner]
    cuts = np.searchsorted(owner, np.arange(1, len(texts)))
    return np.split(found, cuts) if len(texts) else []


def kept_words(n_words: int, runs: np.ndarray) -> np.ndarray:
    """Which words stay when every run keeps its first period only."""
    change = np.zeros(n_words + 1, dtype=np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change[:n_words]) == 0


def periodic_runs(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, `runs` (start, length, period; by start, then period) and `collapsed_text` of every row.

    The collapsed text has the words, joined by one space, that no run holds after its first
    period. Defined cases: a null text is an empty text and has no run; null and repeated ids
    and repeated rows stay, one row each; texts of any length are taken whole; other columns are
    ignored; an empty table gives no row.
    """
    ship(docs.sparkSession)

    def rows_of(ids: pa.Array, texts: list[list[str]]) -> pa.RecordBatch:
        found = runs_of_texts(texts)
        counts = np.array([len(r) for r in found], dtype=np.int64)
        flat = np.concatenate(found) if found else np.zeros((0, 3), dtype=np.int64)
        runs = pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(3)], names=["start", "length", "period"])
        offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        collapsed = [
            " ".join(np.array(words, dtype=object)[kept_words(len(words), r)]) if len(r) else " ".join(words)
            for words, r in zip(texts, found)
        ]
        return pa.RecordBatch.from_arrays(
            [ids, pa.ListArray.from_arrays(offsets, runs), pa.array(collapsed, pa.string())], names=["doc_id", "runs", "collapsed_text"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, first, n_words = [], 0, 0
            for at, value in enumerate(batch.column(1).to_pylist()):
                texts.append(WORD.findall(value or ""))
                n_words += len(texts[-1])
                if n_words >= BATCH_WORDS:
                    yield rows_of(batch.column(0).slice(first, len(texts)), texts)
                    texts, first, n_words = [], at + 1, 0
            if texts:
                yield rows_of(batch.column(0).slice(first, len(texts)), texts)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed_text string")
