"""Classes of near-copies against the exact near-duplicate groups."""

import random

import pytest
from helpers import awkward, empty, sentence

from ledgerlens.llm import copies, near_dup


def by_doc(rows):
    return {r["doc_id"]: r["component_id"] for r in rows}


def test_like_the_exact_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    exact, got = by_doc(near_dup.find(docs).collect()), by_doc(copies.classes(docs).collect())
    assert set(exact) == set(got)
    pairs = [(a, b) for a, b in exact.items() if a != b]
    assert len(pairs) > 50
    assert sum(got[a] == got[b] for a, b in pairs) >= 0.95 * len(pairs)
    # and little else is joined: texts somewhat less similar
    assert len(set(got.values())) >= 0.95 * len(set(exact.values()))


def test_large_groups_are_one_class(spark):
    """Copies with one word changed, in one paragraph or many; other texts share a passage."""
    rng = random.Random(31)
    passage = sentence(rng, 30)
    rows = [(i, f"{sentence(rng, 60)} {passage} {sentence(rng, 60)}") for i in range(200)]
    for base, sep in ((1000, " "), (2000, "\n")):
        words = sentence(rng, 150).split()
        for i in range(300):
            mine = list(words)
            mine[rng.randrange(150)] = f"changed{i}"
            rows.append((base + i, sep.join(mine)))
    got = by_doc(copies.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert len({got[i] for i in range(200)}) == 200
    for base in (1000, 2000):
        assert len({got[base + i] for i in range(300)}) <= 3


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = copies.sketches(docs, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


@pytest.mark.parametrize("make", [awkward, empty])
def test_awkward_rows(spark, make):
    df = make(spark)
    rows = copies.classes(df).collect()
    assert len(rows) == df.count()
    by = {}
    for r in rows:
        by.setdefault(r["doc_id"], set()).add((r["component_id"], r["n_shingles"] > 0))
    if rows:
        assert by[1] == by[2] and len(by[1]) == 1
        assert [ok for i in (3, 4, 5) for _, ok in by[i]] == [False] * 3
        assert len({c for v in by.values() for c, _ in v}) == len(by) - 1
