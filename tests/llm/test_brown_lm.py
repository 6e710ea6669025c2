"""Counts and base scores against a plain model; the class model by what it must satisfy."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from helpers import SF, awkward, documents, empty
from pyspark.sql import functions as F

from ledgerlens.llm import brown_lm as lm
from ledgerlens.llm.catalog import op12_brown_lm


def plain(rows):
    """(n_tokens, n_known, N, base score) of (learn, text) rows."""
    texts = [[w.decode() for w in (t or "").encode().lower().split()] + [None] for _, t in rows]
    c = Counter(w for (ok, _), t in zip(rows, texts) if ok for w in t)
    n, v = sum(c.values()), len(c)
    return [(len(t), sum(w in c for w in t), n,
             sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)) for t in texts]


def check(rows, got):
    for want, r in zip(plain(rows), got):
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == want[:3]
        assert math.isclose(r["base_score"], want[3], rel_tol=1e-9)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_query(spark):
    rows = sorted(((i, t) for i, t, _ in documents()), key=lambda r: r[0])
    got = sorted(op12_brown_lm(spark, SF).collect(), key=lambda r: r["doc_id"])
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    assert [r["doc_id"] for r in got] == [i for i, _ in rows]
    assert [r["held_out"] for r in got] == held
    check([(not h, t) for h, (_, t) in zip(held, rows)], got)


def test_held_out_texts_are_better_predicted_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = lm.score(docs, F.col("doc_id") % 10 != 0).filter("NOT learn").collect()
    known = [r for r in out if r["n_known"] == r["n_tokens"]]
    assert len(known) > 5

    def mean(rows, column):
        return sum(r[column] for r in rows) / sum(r["n_tokens"] for r in rows)
    assert mean(out, "score") > mean(out, "base_score") + 0.3
    assert mean(known, "score") > mean(known, "base_score") + 0.1


def alternating(rng, n):
    return [(i, " ".join(f"{'ab'[k % 2]}{rng.randrange(8)}x" for k in range(40))) for i in range(n)]


def test_exchange_finds_the_classes(spark):
    """Words of two kinds by turns: each kind ends up in classes of its own."""
    docs = spark.createDataFrame(alternating(random.Random(3), 150), "doc_id long, text string")
    words = sorted({w for _, t in alternating(random.Random(3), 150) for w in t.split()})
    number = {w: lm.FIRST + i for i, w in enumerate(words)}
    pairs = lm.bigrams(docs, "text", F.lit(True), number).cache()
    own, matrix, scores = lm.exchange(pairs, len(words), classes=2, tolerance=0.0001)
    kinds = {w[0]: {int(own[i]) for i, x in enumerate(words) if x[0] == w[0]} for w in words}
    assert kinds["a"].isdisjoint(kinds["b"])
    assert scores == sorted(scores) and math.isclose(scores[-1], lm.likelihood(matrix))
    assert matrix.sum() == 150 * 41
    assert np.array_equal(matrix.sum(axis=0), matrix.sum(axis=1))


def test_moves_raise_the_likelihood():
    """Of a single word, the move chosen is the one that brute force finds."""
    rng = np.random.default_rng(1)
    for _ in range(20):
        seq = np.concatenate([[lm.END], rng.integers(0, 12, 400) + lm.FIRST, [lm.END]])
        own = rng.integers(lm.FIRST, lm.FIRST + 4, 12)

        def matrix(own):
            of = np.concatenate([np.arange(lm.FIRST), own])[seq]
            m = np.zeros((lm.FIRST + 4, lm.FIRST + 4))
            np.add.at(m, (of[:-1], of[1:]), 1)
            return m
        of = np.concatenate([np.arange(lm.FIRST), own])
        w = lm.FIRST + 5
        lines = Counter([(0, of[b]) for a, b in zip(seq, seq[1:]) if a == w and b != w]
                        + [(1, of[a]) for a, b in zip(seq, seq[1:]) if b == w and a != w])
        if any(a == b == w for a, b in zip(seq, seq[1:])):
            continue                                    # a word beside itself is weighed roughly
        side, other = np.array([k for k in lines]).T
        best = lm.best_moves(np.zeros(len(side), int), side, other, np.array(list(lines.values())),
                             own[[5]], matrix(own))[0]
        scores = [lm.likelihood(matrix(np.where(np.arange(12) == 5, c, own)))
                  for c in range(lm.FIRST, lm.FIRST + 4)]
        assert scores[best - lm.FIRST] >= sorted(scores)[-2]


def test_infrequent_words_are_placed_by_their_neighbours(spark):
    """Words of two kinds that end alike: each is foretold by the frequent word before it."""
    rng = random.Random(5)
    kinds = [[k + x + y + "x" for x in "bcdfgh" for y in "aeiou"] for k in "nv"]

    def word(k):
        return ["noun", "verb"][k] if rng.random() < 0.3 else rng.choice(kinds[k])
    rows = [(i, " ".join(f"{['the', 'to'][k % 2]} {word(k % 2)}" for k in range(20)))
            for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = lm.score(docs, F.col("doc_id") < 180, classes=4, share=30).filter("NOT learn").collect()
    alone = sum(math.log10(0.3 if w in ("noun", "verb") else 0.7 / 30)
                for i, t in rows[180:] for w in t.split()[1::2])
    assert len(out) == 20 and sum(r["score"] for r in out) > 1.1 * alone


def test_place_weighs_every_class():
    rng = np.random.default_rng(4)
    size = lm.FIRST + 5
    matrix = rng.integers(0, 300, (size, size)).astype(float)
    model = lm.Model(matrix, np.zeros(size), int(matrix.sum()), 500, 10)
    word = np.sort(rng.integers(0, 40, 9000))
    pairs, own = rng.integers(0, size, (9000, 2)), rng.integers(0, lm.END, 40)
    count = np.bincount(word, minlength=40)
    best = lm.place(model, word, pairs, own, count)
    for w in range(40):
        p = pairs[word == w]
        score = {k: (model.follow[p[:, 0], k] + model.follow[k, p[:, 1]]).sum() - count[w] * math.log10(
            model.size[k] + (0 if k == own[w] else count[w])) for k in (own[w], *range(lm.FIRST, size))}
        assert math.isclose(score[best[w]], max(score.values()), abs_tol=1e-3)
    mixed = np.lexsort((rng.random(9000), word))
    assert np.array_equal(best, lm.place(model, word, pairs[mixed], own, count))


def test_neighbours():
    of = np.array([lm.shape_class("ab"), lm.FIRST, lm.shape_class("zz")])
    tokens, lengths = np.array([0, 1, 0, 2, 1, 2]), np.array([3, 0, 2, 1])
    pairs = lm.neighbours(of, np.array([2, 0, 1]), tokens, lengths, np.array([True, True, True, False]),
                          lm.FIRST + 1)
    assert pairs.tolist() == [[lm.END, lm.FIRST], [lm.END, lm.FIRST], [lm.FIRST, lm.END]]


def test_groups_of_words_do_not_change_scores(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")

    def scores():
        return sorted((r["row"]["doc_id"], r["score"]) for r in lm.score(
            docs, F.col("doc_id") % 10 != 0, classes=8, share=500).collect())
    one = scores()
    monkeypatch.setattr(lm, "GROUP_WORDS", 1000)
    assert np.allclose([s for _, s in one], [s for _, s in scores()], rtol=1e-9)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(2)
    size = lm.FIRST + 3
    matrix = rng.integers(0, 50, (size, size)).astype(float)
    tokens = matrix.sum(axis=1).astype(int)
    model = lm.Model(matrix, np.minimum(5.0, tokens), int(tokens.sum()), 100, int(tokens[lm.END]))
    assert np.allclose((10 ** model.follow).sum(axis=1), 1)
    for c in range(size):
        cut = np.array([tokens[c] - 10, 7, 3]) if c != lm.END else np.array([tokens[c]])
        known = 10 ** model.emission(cut, np.full(len(cut), c))
        assert math.isclose(known.sum() + model.unseen[c], 1, rel_tol=1e-9)


def test_shapes_agree(spark):
    words = ["house", "ünïcodé", "中文", "x\U0001f600", "a1", "|", "é", "ends?", "٣"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = [r[0] for r in df.select(lm.shape_column("word")).collect()]
    assert got == [lm.shape_class(w) for w in words]


def test_long_words_keep_their_class_and_stay_apart():
    words = ["x" * 65, "x" * 66, "y" * 65, "x7" * 50, "x7" * 51, "é" * 40, "中" * 30, "7" * 64]
    keys = [lm.word_key(w.encode()) for w in words]
    assert len(set(keys)) == len(words) and keys[-1] == words[-1]
    assert [lm.shape_class(k) for k in keys] == [lm.shape_class(w) for w in words]
    assert all(k[0] == " " and len(k) <= 67 for k in keys[:-1])


def test_packed_numbers():
    for n in (0, 1, 1000):
        numbers = np.random.default_rng(n).integers(0, 1 << 30, n).astype("<i4")
        assert np.array_equal(lm.unpack_numbers(lm.pack_numbers(numbers)), numbers)


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_rows(spark, monkeypatch, make):
    df = make(spark)
    out = lm.score(df, F.col("doc_id") > 2, keep=df.columns)
    rows = out.collect()
    assert len(rows) == df.count()
    check([((r["row"]["doc_id"] or 0) > 2, r["row"]["text"]) for r in rows], rows)


def test_nothing_to_learn(spark):
    rows = lm.score(awkward(spark), F.lit(False)).collect()
    assert len(rows) == 11 and all(r["n_known"] == 0 and math.isfinite(r["score"]) for r in rows)
