"""Exact percentiles of values with many levels, against plain Python."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import percentiles, selection

LEVELS = (("p80", "0.80"), ("p90", "0.90"))


def brute(rows, levels=LEVELS):
    groups = {}
    for key, value in rows:
        if value is not None:
            groups.setdefault(key, []).append(value)
    return {k: (len(v), *[sorted(v)[math.ceil(len(v) * Decimal(p)) - 1] for _, p in levels])
            for k, v in groups.items()}


def select(spark, rows, **args):
    df = spark.createDataFrame(rows, "k string, v double").repartition(7)
    out = selection.select_percentiles(df, ("k",), "v", **args)
    return {r["k"]: tuple(r)[1:] for r in out.collect()}


@pytest.mark.parametrize("small, buckets", [(1, 3), (8, 4), (100, 32), (4096, 32)])
def test_random_groups(spark, small, buckets):
    rng = random.Random(small)
    rows = [("hot", rng.gauss(0, 1e6)) for _ in range(1500)]                # a third of all
    rows += [(None, rng.random()) for _ in range(400)]
    rows += [("one value", 5.0)] * 300
    rows += [("heavy top", 9.0 if rng.random() < 0.97 else rng.random()) for _ in range(600)]
    rows += [("heavy bottom", 0.0 if rng.random() < 0.85 else rng.random()) for _ in range(600)]
    rows += [("spread", 10.0 ** rng.randint(-300, 300)) for _ in range(500)]
    rows += [(f"g{i % 97}", float(rng.randint(0, 12))) for i in range(500)]
    rows += [("nulls", None)] * 5 + [("some nulls", None), ("some nulls", 3.0)]
    assert select(spark, rows, small=small, buckets=buckets) == brute(rows)


def test_levels_at_the_ends(spark):
    levels = (("lowest", "0.001"), ("half", "0.5"), ("all", "1"))
    rows = [("a", float(i * i % 1009)) for i in range(2500)]
    assert select(spark, rows, small=10, buckets=5, levels=levels) == brute(rows, levels)


def test_no_keys_and_no_rows(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1000)], "v double")
    assert [tuple(r) for r in selection.select_percentiles(df, (), "v", small=16).collect()] == [
        (1000, 799.0, 899.0)]
    assert selection.select_percentiles(df.limit(0), (), "v").collect() == []


def test_rounds_end_and_shrink(spark, monkeypatch):
    """Each round keeps about one part in ``buckets`` of the distinct values."""
    rounds = []
    narrow = selection._narrow

    def counted(rows, *args):
        rounds.append(rows.count())
        return narrow(rows, *args)
    monkeypatch.setattr(selection, "_narrow", counted)
    df = spark.range(60_000).select(F.xxhash64("id").cast("double").alias("v"))
    selection.select_percentiles(df, (), "v", levels=(("p", "0.8"),), small=10, buckets=16)
    assert len(rounds) <= 4
    assert all(b <= a / 8 for a, b in zip(rounds, rounds[1:]))


def test_stddev_equals_the_other_exact_method(spark, make_sales):
    rng = random.Random(6)
    rows = [dict(sku=f"s{i % 3}", amount=float(rng.randint(1, 400)), promotion_ids=",".join(
        "p" * (1 + rng.randint(0, 6)))) for i in range(900)] + [dict(sku="one", amount=4.0)]
    orders = percentiles.promo_orders(make_sales(*rows))
    want = percentiles.percentile_stddev(orders, methods=("exact",))
    got = selection.select_percentile_stddev(orders, ("sku", "month"), "promo_count", "amount",
                                             small=2, buckets=3)
    want = {(r["sku"], r["month"]): r for r in want.collect()}
    for r in got.collect():
        w = want.pop((r["sku"], r["month"]))
        assert r["n"] == w["total_orders"]
        for level in ("p80", "p90"):
            assert r[f"threshold_{level}"] == w[f"threshold_{level}_exact"]
            assert r[f"orders_{level}"] == w[f"orders_{level}_exact"]
            assert math.isclose(r[f"stddev_{level}"], w[f"stddev_{level}_exact"], abs_tol=1e-9)
    assert not want
