"""Differences of two written versions, and how little of them is read."""

import random

from ledgerlens.operators import versions
from ledgerlens.session import scratch_path

SCHEMA = "k string, m int, v double, w string"


def write(spark, rows, files=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(files)
    return versions.write_version(df, scratch_path(spark, "version"), ["k", "m"], buckets=16), df.schema


def diff(spark, old, new):
    (a, schema), (b, _) = write(spark, old), write(spark, new, 5)
    found = versions.difference(spark, a, b, schema, ["k", "m"])
    return a, b, found, sorted(((r["k"], r["m"], r["status"], r["old_v"], r["new_v"], r["old_w"],
                                 r["new_w"]) for r in found.collect()), key=str)


def base():
    rng = random.Random(4)
    return [(f"k{i}", i % 4, rng.random(), None if i % 5 == 0 else f"w{i}") for i in range(400)] + [
        (None, 1, 1.0, "null key"), ("nulls", None, None, None), ("zero", 1, 0.0, "z")]


def test_equal_versions_read_nothing(spark):
    rows = base()
    shuffled = rows[::-1]
    shuffled[0] = ("zero", 1, -0.0, "z")                # equal values
    a, b, found, rows = diff(spark, base(), shuffled)
    assert versions.differing_buckets(spark, a, b) == [] and rows == []


def test_added_lost_changed(spark):
    old = base()
    new = [r for r in old if r[0] not in ("k7", "k8")]                       # lost
    new = [(k, m, 9.0 if k == "k9" else v, None if k == "k11" else w) for k, m, v, w in new]
    new = [(k, m, 2.0 if k is None else v, w) for k, m, v, w in new]         # a null key changes
    new += [("new", 1, 1.5, "n"), ("new", None, None, None)]                 # added
    old_by = {r[:2]: r[2:] for r in old}
    want = [("k7", 3, "lost", old_by["k7", 3][0], None, "w7", None),
            ("k8", 0, "lost", old_by["k8", 0][0], None, "w8", None),
            ("k9", 1, "changed", old_by["k9", 1][0], 9.0, "w9", "w9"),
            ("k11", 3, "changed", old_by["k11", 3][0], old_by["k11", 3][0], "w11", None),
            (None, 1, "changed", 1.0, 2.0, "null key", "null key"),
            ("new", 1, "added", None, 1.5, None, "n"), ("new", None, "added", None, None, None, None)]
    a, b, found, rows = diff(spark, old, new)
    assert rows == sorted(want, key=str)
    summary = {r["status"]: r["groups"] for r in versions.difference_summary(found).collect()}
    assert summary == {"lost": 2, "changed": 3, "added": 2}


def test_only_differing_buckets_are_read(spark):
    old = base()
    new = [(k, m, -1.0 if k == "k50" else v, w) for k, m, v, w in old]
    a, b, found, rows = diff(spark, old, new)
    buckets = versions.differing_buckets(spark, a, b)
    assert len(buckets) == 1 and len(rows) == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    filters = [line for line in plan.splitlines() if "PartitionFilters" in line]
    assert filters and all(f"= {buckets[0]})" in x.split("PushedFilters")[0]
                                     for x in filters)


def test_repeated_keys(spark):
    old = [("a", 1, 1.0, "x"), ("a", 1, 1.0, "x"), ("b", 1, 2.0, "y")]
    new = [("a", 1, 1.0, "x"), ("b", 1, 2.0, "y"), ("b", 1, 3.0, "y")]
    *_, rows = diff(spark, old, new)
    assert rows == [("a", 1, "changed", 1.0, 1.0, "x", "x"), ("b", 1, "changed", 2.0, 3.0, "y", "y")]


def test_against_nothing(spark):
    *_, rows = diff(spark, [], base()[:3])
    assert [r[2] for r in rows] == ["added"] * 3
    *_, rows = diff(spark, base()[:3], [])
    assert [r[2] for r in rows] == ["lost"] * 3
