"""Runs of words against brute force over all periods."""

import hashlib
import random
import time
import zlib
from fractions import Fraction

import numpy as np
import pytest
from helpers import SF, awkward, documents, empty

from ledgerlens.llm import word_runs
from ledgerlens.llm.catalog import op11_word_runs


def brute(words):
    """All runs (start, length, period), by start and period."""
    n, seen = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - start + q >= max(6, 4 * q):
                seen.setdefault((start, i - start + q), q)
    return sorted(((s, n, q) for (s, n), q in seen.items()), key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_every_residue_is_a_difference():
    d = {(a - b) % word_runs.MODULUS for a in word_runs.COVER for b in word_runs.COVER}
    assert d == set(range(word_runs.MODULUS))
    inside = set(word_runs.COVER)
    for a in range(word_runs.MODULUS):
        for b in range(word_runs.MODULUS):
            d = int(word_runs.SHIFTS[a, b])
            assert {(a + d) % word_runs.MODULUS, (b + d) % word_runs.MODULUS} <= inside


def test_common_extensions():
    rng = random.Random(2)
    for _ in range(30):
        n = rng.randint(2, 300)
        words = np.array([rng.randrange(2) for _ in range(n)] * rng.randint(1, 3) + [9])
        lce = word_runs.Extensions(words)
        a, b = (np.array([rng.randrange(len(words)) for _ in range(200)]) for _ in range(2))
        a, b = a[a != b], b[a != b]
        for i, j, got in zip(a.tolist(), b.tolist(), lce.of(a, b).tolist()):
            want = 0
            while i + want < len(words) and j + want < len(words) and words[i + want] == words[j + want]:
                want += 1
            assert got == want


def test_random_texts():
    rng = random.Random(5)
    for _ in range(300):
        texts = []
        for _ in range(rng.randint(1, 6)):
            n, k = rng.choice([0, 1, 5, 6, 7, 20, 60, 200]), rng.choice([1, 2, 3, 8])
            words = [str(rng.randrange(k)) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randint(3, 10)
                words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
            texts.append(" ".join(words))
        for text, (n, runs, left) in zip(texts, word_runs.analyse(texts)):
            words = text.split()
            assert (n, runs) == (len(words), brute(words))
            assert left == collapse(words, runs)


def test_very_long_texts():
    began = time.time()
    (_, runs, left), = word_runs.analyse(["a " * 1_000_000])
    assert (runs, left) == ([(0, 1_000_000, 1)], "a")
    words = [f"w{i % 70_001}" for i in range(500_000)]
    (_, runs, left), = word_runs.analyse([" ".join(words)])
    assert (runs, left) == ([(0, 500_000, 70_001)], " ".join(words[:70_001]))
    assert time.time() - began < 60


def query_brute(doc_id, text):
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    if doc_id is not None and n and zlib.crc32(str(doc_id).encode()) % 10 == 0:
        g = zlib.crc32(str(doc_id).encode()) // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
    runs = brute(words)

    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    head = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
    return (doc_id, len(runs), *head, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
            sha(collapse(words, runs)))


def test_query_equals_brute_force(spark):
    got = {r["doc_id"]: tuple(r) for r in op11_word_runs(spark, SF).collect()}
    rows = [(i, t) for i, t, _ in documents()]
    assert len(got) == len(rows)
    assert sum(r[1] > 0 for r in got.values()) >= 10
    for i, text in rows:
        if len((text or "").split()) < 3000:
            assert got[i] == query_brute(i, text)


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_rows(spark, make):
    df = make(spark)
    out = word_runs.detect(df, keep=df.columns)
    assert out.columns == [*df.columns, "n_words", "runs", "collapsed"]
    rows = out.collect()
    assert len(rows) == df.count()
    for r in rows:
        words = [w.decode() for w in (r["text"] or "").encode().split()]
        assert r["n_words"] == len(words)
        if len(words) < 1000:
            runs = brute(words)
            assert [tuple(x) for x in r["runs"]] == runs and r["collapsed"] == collapse(words, runs)
