"""Hot keys: one group holds a third of all lines.  Results must stay exact
(checked against a brute-force pandas computation on the same fixture)."""

import math

import numpy as np
import pandas as pd

from ledgerlens.operators import percentiles as P
from ledgerlens.operators import trailing


def _skewed_orders(spark, n=30_000, seed=7):
    rng = np.random.default_rng(seed)
    hot = n // 3
    sku = np.where(np.arange(n) < hot, "HOT", rng.integers(0, 1500, n).astype(str))
    month = np.where(np.arange(n) < hot, 4, rng.integers(1, 13, n))
    pdf = pd.DataFrame({
        "order_id": np.arange(n).astype(str),
        "sku": sku,
        "month": month.astype("int32"),
        "amount": np.round(rng.uniform(1, 1000, n), 2),
        "promo_count": rng.integers(0, 7, n).astype("int32"),
    })
    df = spark.createDataFrame(
        pdf, "order_id string, sku string, month int, amount double, promo_count int")
    return pdf, df.repartition(16)


def _brute(pdf, p):
    out = {}
    for (sku, month), g in pdf.groupby(["sku", "month"]):
        vals = np.sort(g.promo_count.to_numpy())
        thr = int(vals[math.ceil(len(vals) * p) - 1])
        q = g[g.promo_count >= thr]
        sd = 0.0 if len(q) < 2 else float(np.std(q.amount.to_numpy()))
        out[(sku, int(month))] = (thr, len(q), sd)
    return out


def test_hot_group_percentile_stddev_exact(spark):
    pdf, df = _skewed_orders(spark)
    got = {(r.sku, r.month): r for r in P.percentile_stddev(df).collect()}
    for p, tag in ((0.8, "p80_exact"), (0.9, "p90_exact")):
        want = _brute(pdf, p)
        assert len(want) == len(got)
        for k, (thr, cnt, sd) in want.items():
            r = got[k]
            assert r["threshold_" + tag] == thr and r["orders_" + tag] == cnt, k
            assert abs(r["stddev_" + tag] - sd) < 1e-6 * max(1.0, sd), k
    hot = got[("HOT", 4)]
    assert hot.total_orders == 10_000


def test_hot_group_approx_consistent(spark):
    pdf, df = _skewed_orders(spark)
    w = {(r.sku, r.month): r for r in P.percentile_stddev(df).collect()}
    hot = pdf[(pdf.sku == "HOT")]
    for tag in ("p80_approx", "p90_approx"):
        r = w[("HOT", 4)]
        q = hot[hot.promo_count >= r["threshold_" + tag]]
        assert r["orders_" + tag] == len(q)
        assert abs(r["stddev_" + tag] - float(np.std(q.amount.to_numpy()))) < 1e-6


def test_hot_state_trailing_mode(spark):
    rng = np.random.default_rng(3)
    n = 9_000
    state = np.where(np.arange(n) < n // 3, "HOT", rng.choice(["A", "B", "C", "D"], n))
    day = pd.Timestamp("2022-01-01") + pd.to_timedelta(rng.integers(0, 60, n), unit="D")
    size = rng.choice(["S", "M", "L", "XL"], n)
    pdf = pd.DataFrame({"state": state, "day": day.date, "size": size})
    df = spark.createDataFrame(pdf, "state string, day date, size string").repartition(12)
    got = {(r.state, r.target_date): (r.top_size, r.size_count)
           for r in trailing.trailing_mode(df).collect()}
    # brute force: every (state, target) with its window counts
    want = {}
    for st, g in pdf.groupby("state"):
        days = pd.to_datetime(g.day)
        for t in sorted(set(d + pd.Timedelta(days=k) for d in days.unique() for k in range(1, 8))):
            w = g[(days >= t - pd.Timedelta(days=7)) & (days <= t - pd.Timedelta(days=1))]
            c = w["size"].value_counts()
            best = sorted(c.items(), key=lambda kv: (-kv[1], kv[0]))[0]
            want[(st, t.date())] = (best[0], int(best[1]))
    assert got == want
