"""Windows of any length by events, against the fan-out and plain Python."""

import datetime as dt
import random
import re
from collections import Counter

import pytest

from ledgerlens.operators import trailing, trailing_changes

START = dt.date(2022, 1, 1)


def lines(spark, rows):
    return spark.createDataFrame(rows, "state string, day date, size string")


def random_rows(seed, n=500, span=60):
    rng = random.Random(seed)
    return [(rng.choice(["A", "B", "C", None]), START + dt.timedelta(rng.randrange(span)),
             rng.choice(["S", "M", "L", "XL"])) for _ in range(n)] + [
        ("far", dt.date(1969, 12, 30), "S"), ("far", dt.date(2024, 2, 28), "M")]


def brute(rows, days):
    out = {}
    for state in {r[0] for r in rows}:
        counts = {}
        for s, day, size in rows:
            if s == state:
                for k in range(1, days + 1):
                    counts.setdefault(day + dt.timedelta(k), Counter())[size] += 1
        for target, c in counts.items():
            n, size = min((-n, size) for size, n in c.items())
            out[state, target] = (size, -n)
    return out


@pytest.mark.parametrize("days", [1, 2, 7, 64, 180])
def test_equals_brute_force(spark, days):
    rows = random_rows(days)
    got = trailing_changes.trailing_mode_by_changes(lines(spark, rows), days=days).collect()
    result = {(r["state"], r["target_date"]): (r["top_size"], r["size_count"]) for r in got}
    assert len(result) == len(got) and result == brute(rows, days)


def test_equals_the_fan_out(spark):
    df = lines(spark, random_rows(5, 900, 200))
    a, b = (sorted(map(str, f(df, days=30).collect())) for f in (
        trailing.trailing_mode, trailing_changes.trailing_mode_by_changes))
    assert a == b


def test_intervals(spark):
    df = lines(spark, random_rows(9))
    parts = trailing_changes.mode_changes(df, days=90)
    merged = trailing_changes.merged_changes(parts)
    for frame in (parts, merged):
        days = {}
        for r in frame.collect():
            assert r["valid_from"] <= r["valid_to"]
            for k in range((r["valid_to"] - r["valid_from"]).days + 1):
                key = r["state"], r["valid_from"] + dt.timedelta(k)
                assert key not in days
                days[key] = (r["top_size"], r["size_count"])
        assert days == brute(random_rows(9), 90)
    rows = sorted((str(r["state"]), r["valid_from"], r["valid_to"], r["top_size"], r["size_count"])
                  for r in merged.collect())
    for a, b in zip(rows, rows[1:]):
        assert (a[0], a[3:]) != (b[0], b[3:]) or a[2] + dt.timedelta(1) < b[1]


def test_nothing_grows_with_the_length(spark):
    """Two events a reduced row, and as many change points, whatever the length."""
    rows = random_rows(3, 400, 400)
    df = lines(spark, rows)
    daily = len(set(rows))
    found = {days: trailing_changes.mode_changes(df, days=days).count() for days in (30, 3000)}
    assert all(n <= 2 * daily for n in found.values())
    plans = []
    for days in (30, 3000):
        plan = trailing_changes.mode_changes(df, days=days)._jdf.queryExecution().optimizedPlan()
        plans.append(re.findall(r"^\W*(\w+)", plan.toString(), re.M))
    assert plans[0] == plans[1]


def test_no_rows(spark):
    df = lines(spark, [])
    assert trailing_changes.trailing_mode_by_changes(df).collect() == []
