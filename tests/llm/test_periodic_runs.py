"""Runs against a search over all periods, the query against the contract, odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from tickerloom.llm.periodic_runs import PRIME, WORD, periodic_runs, runs_of_texts, transform
from tickerloom.llm.queries import op12_periodic_runs


def all_runs(words):
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            s = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(12, 2 * q):
                found.setdefault((s, i + q), q)
            i = max(i, s + 1)
    return sorted((s, e - s, q) for (s, e), q in found.items())


@pytest.mark.parametrize("seed", range(8))
def test_all_runs_are_found(seed):
    draw = random.Random(seed)
    for _ in range(25):
        texts = []
        for _ in range(draw.randint(1, 5)):
            n = draw.choice([0, 1, 11, 12, 13, 24, 40, 150, 300])
            words = [draw.choice("abcdefghij"[: draw.choice([1, 2, 2, 3, 10])]) for _ in range(n)]
            if n and draw.random() < 0.5:
                a = draw.randrange(n)
                p = 1 + draw.randrange(max(1, (n - a) // 2))
                words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            texts.append(words)
        got = [[tuple(r) for r in runs.tolist()] for runs in runs_of_texts(texts)]
        assert got == [all_runs(words) for words in texts]


def test_fibonacci_words_have_runs_at_every_scale():
    a, b = "a", "ab"
    while len(b) < 1500:
        a, b = b, b + a
    assert [tuple(r) for r in runs_of_texts([list(b)])[0].tolist()] == all_runs(list(b))


def test_transform_is_a_cyclic_convolution():
    draw = np.random.default_rng(1)
    x, y = draw.integers(0, PRIME, (2, 3, 32)).astype(np.uint64)
    got = transform(transform(x) * transform(y) % np.uint64(PRIME), inverse=True)
    for r in range(3):
        expected = [sum(int(x[r, i]) * int(y[r, (k - i) % 32]) for i in range(32)) % PRIME for k in range(32)]
        assert got[r].tolist() == expected


def expected_row(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = all_runs(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
    return (
        doc_id, len(runs), *best, best[1] * 1000 // best[2] if runs else None,
        digest("".join(f"{s},{length},{q}\n" for s, length, q in runs)),
        digest(" ".join(w for i, w in enumerate(words) if i not in dropped)),
    )


def test_query_on_odd_and_periodic_texts(spark, tmp_path):
    draw = random.Random(4)
    rows = [(1, None), (2, ""), (None, "la " * 40), (3, " \t\x0b"), (4, "x y " * 30), (4, "x y " * 30), (5, "one two")]
    rows += [(i, " ".join(draw.choice(["a", "b", "c d"]) for _ in range(draw.randint(1, 120)))) for i in range(6, 150)]
    rows += [(150, " ".join(str(i % 700) for i in range(3000))), (151, "w" * 200000)]
    docs = spark.createDataFrame([(i, t, "s", 1) for i, t in rows], "doc_id long, text string, runs string, longest int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_periodic_runs(spark, str(tmp_path)).collect()]
    key = lambda r: tuple((v is None, v or 0) for v in r[:2]) + r[6:]
    assert sorted(got, key=key) == sorted((expected_row(i, t) for i, t in rows), key=key)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows if i) >= 5
    assert periodic_runs(docs.limit(0)).count() == 0
