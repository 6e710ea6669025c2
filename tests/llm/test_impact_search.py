"""Ranked search against a plain scorer; the SQL form is compared in test_oracles.py."""

import math
import random
import re

import numpy as np
import pytest
from helpers import awkward, empty, sentence

from ledgerlens.llm import impact_search as search

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def tokens(text):
    return [t.translate(UPPER) for t in re.findall(search.TERM, text or "")]


def brute(docs, items, k):
    docs = [(i, t) for i, t in ((i, tokens(x)) for i, x in docs) if t]
    n, total, df, asked = len(docs), sum(len(t) for _, t in docs), {}, {}
    for _, t in docs:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    for i, text in items:
        if i is not None:
            asked.setdefault(i, set()).update(tokens(text))
    out = []
    for item, terms in asked.items():
        found = []
        for i, t in docs:
            m = 50 + (50 * len(t) * n) // total
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[x] + 1)))
                        * (10 ** 9 * t.count(x) // (1000 * t.count(x) + 20 * m))
                        for x in terms if x in t)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, r, i, -s) for r, (s, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out)


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_terms():
    text = "Straße ÄPFEL x_y 3.5 foo-BAR\x00z\t中文 don't"
    assert [t.decode() for t in search.terms(text)] == tokens(text)
    assert tokens(text)[:2] == ["straße", "Äpfel"] and search.terms(None) == []


@pytest.mark.parametrize("block_items, tile_docs, tile_terms, held",
                         [(2048, 1024, 1024, 1 << 20), (3, 7, 5, 20)])
def test_random_documents_with_ties(spark, monkeypatch, block_items, tile_docs, tile_terms, held):
    monkeypatch.setattr(search, "BLOCK_ITEMS", block_items)
    rng = random.Random(4)
    texts = [sentence(rng, rng.randint(0, 60)) for _ in range(120)]
    docs = [(i, rng.choice(texts) if i % 3 else texts[i % 5]) for i in range(400)]  # many ties
    items = [(i, sentence(rng, 8)) for i in range(9)] + [(9, "nowhere"), (10, None), (3, "the of")]
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    i = spark.createDataFrame(items, "item_id long, text string")
    assert rows(search.search(d, i, 5)) == brute(docs, items, 5)


def test_small_tiles_and_early_cuts(monkeypatch):
    """The same scores and the same best rows, however the work is cut."""
    rng = random.Random(8)
    docs = [sentence(rng, rng.randint(1, 40)) for _ in range(300)] + ["the of"] * 40
    items = {i: set(search.terms(sentence(rng, 10))) for i in range(12)}
    vocabulary = set().union(*items.values())
    df = {t: sum(t in search.terms(x) for x in docs) for t in vocabulary}
    total = sum(len(search.terms(x)) for x in docs)
    block = search.Block(items, len(docs), total, df)
    whole = block.scores(search.Tile(docs, block.number))
    import pyarrow as pa

    def tiles(n):
        for lo in range(0, len(docs), n):
            yield pa.array(range(lo, min(lo + n, len(docs)))), docs[lo:lo + n]
    want = [x.tolist() for x in search.best(block, tiles(1000), 7)]
    monkeypatch.setattr(search, "TILE_TERMS", 3)
    monkeypatch.setattr(search, "HELD", 30)
    assert np.array_equal(block.scores(search.Tile(docs, block.number)), whole)
    assert [x.tolist() for x in search.best(block, tiles(11), 7)] == want


def test_sums_that_would_not_be_exact_are_refused(monkeypatch):
    monkeypatch.setattr(search, "TILE_TERMS", 1 << 33)
    with pytest.raises(ValueError):
        search.Block({1: {b"a"}}, 10 ** 6, 10 ** 8, {b"a": 1})


def test_awkward_rows(spark):
    df, items = awkward(spark), awkward(spark).withColumnRenamed("doc_id", "item_id")
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert rows(search.search(df, items, 4)) == brute(docs, docs, 4)
    none = empty(spark)
    assert rows(search.search(none, items)) == []
    assert rows(search.search(df, none.withColumnRenamed("doc_id", "item_id"))) == []
