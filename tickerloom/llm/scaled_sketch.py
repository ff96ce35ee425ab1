"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the range of hashes, so it grows with
its document, and two sketches hold the same choice of the shingles their documents share: how much of a short document a long one
contains can be read off them, which sketches of a fixed size cannot tell. Texts with few shingles
below the fraction keep their LEAST smallest hashes, so short texts are held whole. Both
rules merge: the sketch of a union is the same choice from the union of the sketches.

Shingles have five words (the whole text where it has fewer; none without a word). A word is
hashed once; shingle hashes are a polynomial of their word hashes, mixed, over whole batches of texts.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.llm.common import let, ship
from tickerloom.llm.ordered_buckets import beside_successors

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHINGLE_WORDS = 5
# Hashes have 63 bits, so that they order alike as signed longs; one in eight is kept.
FRACTION = 8
THRESHOLD = (1 << 63) // FRACTION
LEAST = 16
BATCH_ROWS = 512
CACHED_WORDS = 1 << 18


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (values ^ (values >> np.uint64(31))) >> np.uint64(1)


def shingle_hashes(words: np.ndarray) -> np.ndarray:
    """Hashes of the shingles that start at each word hash but the last SHINGLE_WORDS - 1; of the whole row if it is shorter."""
    if not len(words):
        return words
    width = min(SHINGLE_WORDS, len(words))
    count = len(words) - width + 1
    total = np.full(count, width, dtype=np.uint64)
    for k in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[k : k + count]
    return _mixed(total)


def choice(hashes: np.ndarray) -> np.ndarray:
    """The sketch of a set of hashes, ascending: those below the threshold, at least the LEAST smallest."""
    low = np.unique(hashes[hashes < THRESHOLD])
    return low if len(low) >= LEAST else np.unique(hashes)[:LEAST]


def sketches(texts: list[str], known: WordHashes) -> list[np.ndarray]:
    words = [WORD.findall(text) for text in texts]
    lengths = np.array([len(w) for w in words], dtype=np.int64)
    flat = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), dtype=np.uint64, count=int(lengths.sum()))
    ends = np.cumsum(lengths)
    # Shingles of the whole row at once; those that reach into the next text are never read.
    joint = shingle_hashes(flat)
    result = []
    for length, end in zip(lengths.tolist(), ends.tolist()):
        begin = end - length
        result.append(choice(joint[begin : end - SHINGLE_WORDS + 1] if length >= SHINGLE_WORDS else shingle_hashes(flat[begin:end])))
    return result


def _arrays(values: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(v) for v in values])]).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0)
    return pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int64)))


def sketch_documents(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id and `sketch` (ascending hashes) of every row's whole text.

    Defined cases: null text is empty text and has an empty sketch; null and repeated ids and
    repeated rows stay; other columns are ignored; an empty table gives no row.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                found = sketches([t or "" for t in part.column(1).to_pylist()], known)
                yield pa.RecordBatch.from_arrays([part.column(0), _arrays(found)], names=["doc_id", "sketch"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, sketch array<long>")


def merged(sketch: str) -> Column:
    """An aggregate: the sketch of all texts of a group. Hashes below the threshold bound its size."""
    every = F.array_sort(F.array_distinct(F.flatten(F.collect_list(sketch))))
    low = F.filter(every, lambda h: h < THRESHOLD)
    return F.when(F.size(low) >= LEAST, low).otherwise(F.slice(every, 1, LEAST))


def _complete_below(sketch: Column) -> Column:
    """Hashes up to this one are all in the sketch if they are in its text."""
    return (
        F.when(F.size(sketch) < LEAST, F.lit((1 << 63) - 1))
        .when(F.get(sketch, F.lit(LEAST - 1)) < THRESHOLD, F.lit(THRESHOLD - 1))
        .otherwise(F.get(sketch, F.lit(LEAST - 1)))
    )


def containment(own: str, other: str) -> Column:
    """The share of `own`'s shingles that `other` holds too, by the hashes both sketches would have kept.

    Equal sketches, empty ones too, give 1; without a hash to compare it is 0.
    """
    a, b = F.col(own), F.col(other)
    limit = F.least(_complete_below(a), _complete_below(b))
    share = let(
        F.filter(a, lambda h: h <= limit),
        lambda kept: F.when(F.size(kept) == 0, 0.0).otherwise(F.size(F.array_intersect(kept, b)) / F.size(kept)),
    )
    return F.when(a == b, 1.0).otherwise(share)


def as_text(sketch: str) -> Column:
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def replace_tail(text: str, following: str) -> str:
    """The text with its last quarter of code points replaced by the first as many of the following one."""
    cut = len(text) // 4
    return text[: len(text) - cut] + following[:cut]


def sketch_edits(docs: DataFrame, edit: Callable[[str, str], str] = replace_tail) -> DataFrame:
    """doc_id, n_chars, sketch, edited_text, edited_sketch, next_sketch of every row.

    `edit` makes the edited text from a text and the one that follows it by ascending doc_id; the
    first follows the last. Order of equal ids, nulls and odd rows: see `beside_successors`
    and `sketch_documents`. A table of one row has itself for a successor.
    """
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        held: tuple[bool, int | None, str, np.ndarray] | None = None
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(at, BATCH_ROWS)
                texts = part.column("text").to_pylist()
                rows = list(zip(part.column("is_tail").to_pylist(), part.column("doc_id").to_pylist(), texts, sketches(texts, known)))
                chained = rows if held is None else [held, *rows]
                held = chained[-1]
                # A tail only closes its bucket; the row after it begins another.
                pairs = [(row, following) for row, following in zip(chained, chained[1:]) if not row[0]]
                edited = [edit(row[2], following[2]) for row, following in pairs]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row[1] for row, _ in pairs], pa.int64()),
                        pa.array([len(row[2]) for row, _ in pairs], pa.int64()),
                        _arrays([row[3] for row, _ in pairs]),
                        pa.array(edited, pa.string()),
                        _arrays(sketches(edited, known)),
                        _arrays([following[3] for _, following in pairs]),
                    ],
                    names=["doc_id", "n_chars", "sketch", "edited_text", "edited_sketch", "next_sketch"],
                )

    schema = "doc_id long, n_chars long, sketch array<long>, edited_text string, edited_sketch array<long>, next_sketch array<long>"
    return beside_successors(docs).mapInArrow(run, schema)
