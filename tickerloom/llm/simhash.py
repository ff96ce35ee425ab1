"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint is cut into 32 segments of two bits; the counts of set bits per segment are a
vector whose Manhattan distance is at most the Hamming distance. Of two fingerprints at
three or fewer differing bits, one half differs in at most one bit, so that half's vectors
are at distance one or less: they lie in the same or in a neighbouring grid cell. Vectors
at distance one have element sums of opposite parity, so only odd vectors look into their
neighbours' cells and every pair meets at most once per half. A join on (half, cell) finds the
candidates, the Manhattan distance of both halves and then the exact bit count decide.

Work is done on distinct fingerprints: any number of copies is one row after a map-side
aggregate. Links between fingerprints are reduced to components by alternating
star contraction, one written table per round.

Defined cases: null and empty texts have no words and fingerprint zero, linked like any
other; rows with a null doc_id get a fingerprint but no component (null); repeated
doc_ids join the components of all their texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickerloom.llm.common import ship, stored

SEED = 42
SHINGLE = 3
MAX_BITS = 3
PAIRS_OF_BITS = 0x55555555
LOW_HALF = 0xFFFFFFFF
SEGMENTS_PER_HALF = 16


def shingle_hashes(text: str | None) -> np.ndarray:
    """XXH64 of the lower-cased three-word shingles, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, dtype="<u8")
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    if len(words) < SHINGLE:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype="<u8")
    starts = np.concatenate(([0], ends[:-SHINGLE] + 1)).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[SHINGLE - 1 :].tolist())], dtype="<u8")


def fingerprint(text: str | None) -> int:
    hashes = shingle_hashes(text)
    if not len(hashes):
        return 0
    total = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 65536):
        block = hashes[at : at + 65536]
        total += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            values = np.array([fingerprint(t) for t in part.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values)], names=["doc_id", "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp, the fingerprint's bits as a signed long."""
    ship(docs.sparkSession)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(_fingerprints, "doc_id long, fp long")


def halves_of(bits: Column) -> list[Column]:
    return [bits.bitwiseAND(F.lit(LOW_HALF)), F.shiftrightunsigned(bits, 32)]


def popcounts(half: Column) -> Column:
    """Each two-bit segment's number of set bits, in the same two bits."""
    ones = half.bitwiseAND(F.lit(PAIRS_OF_BITS))
    twos = F.shiftrightunsigned(half, 1).bitwiseAND(F.lit(PAIRS_OF_BITS))
    return ones + twos


def manhattan(a: Column, b: Column) -> Column:
    """Distance of the popcount vectors of two fingerprints: 0, 1, 2 differ as the unary codes 00, 01, 11 do."""

    def unary(half: Column) -> Column:
        counts = popcounts(half)
        return counts.bitwiseOR(F.shiftrightunsigned(counts, 1).bitwiseAND(F.lit(PAIRS_OF_BITS)))

    distances = [F.bit_count(unary(x).bitwiseXOR(unary(y))) for x, y in zip(halves_of(a), halves_of(b))]
    return distances[0] + distances[1]


def links(distinct: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Pairs a < b of fingerprints at `max_bits` (at most three) or fewer differing bits."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError("the halves' grid covers at most three differing bits")
    cells = [F.struct(F.lit(i).alias("half"), popcounts(h).alias("cell")) for i, h in enumerate(halves_of(F.col("fp")))]
    halves = distinct.select("fp", F.explode(F.array(*cells)).alias("s")).select("fp", "s.half", "s.cell")
    # The sum's parity is that of the segments whose count is one.
    odd = F.bit_count(F.col("cell").bitwiseAND(F.lit(PAIRS_OF_BITS))) % 2 == 1
    steps = []
    for segment in range(SEGMENTS_PER_HALF):
        count = F.shiftright("cell", 2 * segment).bitwiseAND(F.lit(3))
        step = 1 << (2 * segment)
        steps += [F.when(count < 2, F.col("cell") + step), F.when(count > 0, F.col("cell") - step)]
    around = F.filter(F.array(*steps), lambda cell: cell.isNotNull())
    looking = halves.select(
        F.col("fp").alias("a"), "half",
        F.explode(F.when(odd, F.concat(F.array("cell"), around)).otherwise(F.array("cell"))).alias("cell"), F.col("cell").alias("own"),
    )
    standing = halves.select(F.col("fp").alias("b"), "half", "cell")
    # Pairs of one cell are seen from both sides: keep one. Pairs of two cells are seen from the odd one only.
    found = looking.alias("l").join(
        standing.alias("s"),
        (F.col("l.half") == F.col("s.half")) & (F.col("l.cell") == F.col("s.cell"))
        & ((F.col("own") != F.col("l.cell")) | (F.col("a") < F.col("b")))
        & (manhattan(F.col("a"), F.col("b")) <= max_bits)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)
        & (F.col("a") != F.col("b")),
    )
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame, rows: int | None = None) -> DataFrame:
    """node and root (the smallest node reachable) for every node of the undirected `edges` (a, b).

    Alternating large and small stars: each round links every node to the least neighbour
    known; the tables are written, and rounds end when the edges stay as they are. `rows`: about how many
    edges there are; each round counts its own.
    """
    current = stored(edges.select(F.least("a", "b").alias("low"), F.greatest("a", "b").alias("high"))
                     .where("low < high").distinct(), "stars", rows)
    signature = None
    while True:
        both = current.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(
            current.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("m"))
        large = stored(
            both.where("other > node").join(least, "node").select(F.col("m").alias("low"), F.col("other").alias("high"))
            .where("low < high").distinct(), "large", rows)
        least = large.groupBy("high").agg(F.min("low").alias("m"))
        pulled = large.join(least, "high")
        small = stored(
            pulled.select(F.col("m").alias("low"), "high").unionByName(pulled.select(F.col("m").alias("low"), F.col("low").alias("high")))
            .where("low < high").distinct(), "small", rows)
        now = small.agg(F.count("*"), F.sum(F.xxhash64("low", "high").cast("decimal(38,0)"))).first()
        current = small
        rows = now[0]
        if now == signature:
            return current.groupBy(F.col("high").alias("node")).agg(F.min("low").alias("root"))
        signature = now


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable) per row of `docs`."""
    marked = stored(fingerprints(docs), "fingerprints")
    n_rows = marked.count()
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes", n_rows)
    roots = components(links(classes.select("fp")), n_rows)
    # Rows that share a doc_id tie their classes together as well.
    tied = marked.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a < b")
    if not tied.isEmpty():
        shared = marked.join(tied.select("doc_id", "a"), "doc_id").select("a", F.col("fp").alias("b")).where("a < b").distinct()
        roots = components(links(classes.select("fp")).unionByName(shared), n_rows)
    rooted = classes.join(roots, classes["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root"))
    whole = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_class = stored(rooted.join(whole, "root").select("fp", "component_id"), "members", n_rows)
    return marked.join(by_class, "fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )
