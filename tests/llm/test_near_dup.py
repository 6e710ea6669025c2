"""Components equal brute force over all pairs, also where groups are split."""

import random

import numpy as np
import pytest
from helpers import SF, awkward, documents, empty, sentence

from ledgerlens.llm import near_dup
from ledgerlens.llm.catalog import LLM_QUERIES


def brute(rows, k, percent=80):
    """{doc: (set size, component)} by comparing all pairs."""
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split()
        n = min(k, len(w))
        sets[i] = {tuple(w[j:j + n]) for j in range(len(w) - n + 1)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[:x]:
            s, t = sets[a], sets[b]
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)):
                both = len(s & t)
                if 100 * both >= percent * (len(s) + len(t) - both):
                    p, q = find(a), find(b)
                    root[max(p, q)] = min(p, q)
    return {i: (len(sets[i]), find(i)) for i in sets}


def compare(spark, rows, k):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"])
           for r in near_dup.find(df, size=k).collect()}
    want = {i: (n, c, c == i) for i, (n, c) in brute(rows, k).items()}
    assert got == want


def edited(rng, text, share):
    return " ".join(w if rng.random() > share else "new" + str(rng.randint(0, 10 ** 6))
                    for w in text.split())


@pytest.fixture
def group_rows():
    """A group with similarities on both sides of the limit, copies, and strangers."""
    rng = random.Random(2)
    base = sentence(rng, 60)
    texts = [edited(rng, base, rng.choice([0, .02, .05, .08, .12])) for _ in range(60)]
    texts += [texts[0]] * 5 + [sentence(rng, rng.randint(1, 40)) for _ in range(40)]
    shared = sentence(rng, 25)
    texts += [f"{shared} {sentence(rng, 12)}" for _ in range(40)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("k", [2, 5])
def test_groups(spark, group_rows, k):
    compare(spark, group_rows, k)


def test_groups_in_small_blocks(spark, group_rows, monkeypatch):
    for name, value in (("SMALL_BUCKET", 3), ("BLOCK", 8), ("TEXT_BLOCK", 8)):
        monkeypatch.setattr(near_dup, name, value)
    compare(spark, group_rows, 2)


def test_query_over_whole_table(spark):
    rows = [(i, t) for i, t, _ in documents()]
    got = {r["doc_id"]: tuple(r[1:]) for r in LLM_QUERIES["op6_minhash"](spark, SF).collect()}
    assert got == {i: (n, c, c == i) for i, (n, c) in brute(rows, 2).items()}


def test_estimate_is_corrected_for_chance():
    rng = np.random.default_rng(1)
    for j in (0.0, 0.5, 0.8):
        errors = []
        for _ in range(20):
            n = round(800 * j / (1 + j))                    # shared by two sets of 400
            both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
            a, b = (np.concatenate([both, rng.integers(0, 1 << 63, 400 - n, dtype=np.uint64)])
                    for _ in range(2))
            true = n / (800 - n)
            x = near_dup.pack(near_dup.minima(a)) ^ near_dup.pack(near_dup.minima(b))
            x = x.view(np.uint64)
            unequal = int(np.bitwise_count((x | x >> np.uint64(1))
                                           & np.uint64(near_dup.EVEN)).sum())
            errors.append(near_dup.similarity(unequal) - true)
        assert abs(np.mean(errors)) < 0.05


def test_bound_keeps_pairs_at_the_limit():
    assert near_dup.similarity(near_dup.most_unequal(80)) < 0.55
    assert near_dup.most_unequal(95) < near_dup.most_unequal(80)


def test_awkward_and_empty(spark):
    rows = near_dup.find(awkward(spark), size=2).collect()
    assert len(rows) == 11
    by = {r["doc_id"]: r for r in rows}
    assert by[2]["component_id"] == 1 and not by[2]["kept"] and by[1]["kept"]
    for i in (3, 4, 5):
        assert (by[i]["n_shingles"], by[i]["component_id"], by[i]["kept"]) == (0, i, True)
    assert by[6]["n_shingles"] == 1 and by[None]["component_id"] is None and by[None]["kept"]
    left = near_dup.survivors(awkward(spark), size=2)
    assert left.columns == awkward(spark).columns
    assert sorted(r["doc_id"] or 0 for r in left.collect()) == [0, 1, 3, 4, 5, 6, 7, 8, 9]
    assert near_dup.find(empty(spark)).count() == 0 and near_dup.survivors(empty(spark)).count() == 0
