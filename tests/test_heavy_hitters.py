"""Exact heavy keys from bounded summaries, against full counts."""

import random
from collections import Counter

import pandas as pd
import pytest

from ledgerlens.operators import heavy_hitters


def rows(seed, n=6000):
    rng = random.Random(seed)
    out = [("hot", 1)] * (n // 3) + [(None, 2)] * (n // 20) + [("a", None)] * (n // 25)
    out += [("edge", 3)] * 60
    while len(out) < n:
        out.append((f"k{rng.randrange(2000)}", rng.randrange(50)))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("share", [0.3, 0.05, 0.01, 0.002])
def test_equals_full_counts(spark, share):
    data = rows(3)
    df = spark.createDataFrame(data, "a string, b int").repartition(6)
    got = {(r["a"], r["b"]): (r["lines"], r["total_lines"])
           for r in heavy_hitters.heavy_keys(df, ["a", "b"], share).collect()}
    assert got == {k: (n, len(data)) for k, n in Counter(data).items() if n > share * len(data)}


def test_a_share_is_exceeded_not_reached(spark):
    df = spark.createDataFrame([("x",)] * 50 + [("y",)] * 25 + [("z",)] * 25, "a string")
    assert [r["a"] for r in heavy_hitters.heavy_keys(df, ["a"], 0.25).collect()] == ["x"]


def test_summaries_are_bounded_and_lose_little(spark):
    data, counters = rows(9), 40
    df = spark.createDataFrame(data, "a string, b int").repartition(5)
    parts = df.rdd.getNumPartitions()
    found = heavy_hitters.summaries(df, ["a", "b"], counters).collect()
    assert len(found) <= parts * (counters + 1) and sum(r["seen"] for r in found) == len(data)
    summed = Counter()
    for r in found:
        if r["text"] is not None:
            summed[r["text"]] += r["n"]
    true = Counter(r[0] for r in df.selectExpr(
        "to_json(struct(a, b), map('ignoreNullFields', 'false'))").collect())
    for key, n in true.items():
        assert n - len(data) / (counters + 1) <= summed[key] <= n


def test_lowered():
    counts = pd.Series({"a": 9, "b": 5, "c": 5, "d": 2})
    assert heavy_hitters.lowered(counts, 2).to_dict() == {"a": 4}
    assert heavy_hitters.lowered(counts, 3).to_dict() == {"a": 7, "b": 3, "c": 3}
    assert heavy_hitters.lowered(counts, 4) is counts


def test_no_rows(spark):
    assert heavy_hitters.heavy_keys(spark.createDataFrame([], "a string"), ["a"], 0.1).collect() == []
