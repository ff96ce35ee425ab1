"""Sketches against sets of shingles, successors against a sorted list, merging, odd rows."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tickerloom.llm.ordered_buckets import beside_successors
from tickerloom.llm.queries import op13_scaled_sketch
from tickerloom.llm.scaled_sketch import LEAST, THRESHOLD, WORD, WordHashes, choice, containment, merged, shingle_hashes, sketch_documents, sketches


def shingles(text):
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def text_of(draw, n, vocabulary=400):
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


def test_a_sketch_keeps_every_hash_below_the_threshold():
    draw, known = random.Random(2), WordHashes()
    texts = [text_of(draw, n) for n in (0, 1, 4, 5, 6, 20, 25, 400, 3000)] + ["", " \t", "a b"]
    for text, sketch in zip(texts, sketches(texts, known)):
        every = {}
        for s in shingles(text):
            import numpy as np

            every[s] = int(shingle_hashes(np.array([known[w] for w in s], dtype=np.uint64))[0])
        low = sorted(h for h in every.values() if h < THRESHOLD)
        assert sketch.tolist() == (low if len(low) >= LEAST else sorted(every.values())[:LEAST])


def test_containment_of_unequal_texts(spark):
    draw = random.Random(3)
    long = text_of(draw, 20000, 10**6)
    words = long.split()
    half = " ".join(words[5000:6000]) + " " + text_of(draw, 1000, 10**6)
    docs = spark.createDataFrame([(1, long), (2, half), (3, "short text only"), (4, "short text only"), (5, None)], "doc_id long, text string")
    found = sketch_documents(docs)
    pairs = found.alias("a").crossJoin(found.alias("b").select(F.col("doc_id").alias("other_id"), F.col("sketch").alias("other")))
    got = {(r.doc_id, r.other_id): r.near for r in pairs.select("doc_id", "other_id", containment("sketch", "other").alias("near")).collect()}
    assert got[2, 1] == pytest.approx(0.5, abs=0.12) and got[1, 2] == pytest.approx(0.05, abs=0.03)
    assert got[1, 1] == got[3, 4] == got[5, 5] == 1.0
    assert got[3, 1] == got[3, 5] == got[5, 3] == 0.0


def test_sketches_merge(spark):
    draw, known = random.Random(4), WordHashes()
    texts = [text_of(draw, n) for n in (3, 30, 300, 5, 2000)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    row = sketch_documents(docs).agg(merged("sketch").alias("sketch")).first()
    parts = sketches(texts, known)
    import numpy as np

    assert row.sketch == choice(np.concatenate(parts)).tolist()


def expected_pairs(rows):
    from xxhash import xxh64_intdigest

    signed = lambda t: (lambda v: v - (1 << 64) if v >> 63 else v)(xxh64_intdigest(t.encode(), seed=42))
    ordered = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1]), r[1]))
    return [(row, ordered[(k + 1) % len(ordered)]) for k, row in enumerate(ordered)]


def odd_rows():
    draw = random.Random(5)
    rows = [(i * 7 % 1009, text_of(draw, draw.choice([0, 1, 3, 10, 60]))) for i in range(300)]
    rows += [(None, "x"), (None, None), (5, None), (5, ""), (5, "é" * 9), (2**62, "a b c"), (2**62 + 1, "d")]
    rows += [(77, text_of(draw, 8)) for _ in range(200)] + [(77, "same row")] * 20
    return rows


@pytest.mark.parametrize("bucket_bytes", [500, 3000, 1 << 20])
def test_every_row_meets_its_successor(spark, bucket_bytes):
    rows = odd_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    chained = beside_successors(docs, bucket_bytes).withColumn("task", F.spark_partition_id())
    got = []
    held = None
    for r in chained.collect():
        if held is not None and not held.is_tail:
            assert held.bucket == r.bucket
            got.append(((held.doc_id, held.text), (r.doc_id, r.text)))
        held = r
    assert held.is_tail
    expected = expected_pairs(rows)
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    if bucket_bytes == 500:
        # Rows that share an id are dealt over several buckets.
        assert chained.where("doc_id = 77 AND NOT is_tail").select("bucket").distinct().count() > 3


def test_query_on_odd_rows(spark, tmp_path):
    rows = odd_rows()
    frame = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], "doc_id long, text string, sketch string, bucket int")
    frame.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted((r.doc_id or -1, r.n_chars, r.edited_sha256) for r in op13_scaled_sketch(spark, str(tmp_path)).collect())
    expected = []
    for (doc_id, text), (_, following) in expected_pairs(rows):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + following[:cut]
        expected.append((doc_id or -1, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert got == sorted(expected)
    near = op13_scaled_sketch(spark, str(tmp_path))
    assert near.where("near_edited < 0 OR near_edited > 1 OR near_next < 0 OR near_next > 1").count() == 0
    single = frame.limit(1)
    single.write.parquet(f"{tmp_path}/one/documents.parquet")
    assert op13_scaled_sketch(spark, f"{tmp_path}/one").select("near_next").collect()[0][0] == 1.0
    frame.limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    assert op13_scaled_sketch(spark, f"{tmp_path}/none").count() == 0
