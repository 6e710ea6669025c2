from conftest import SF

from pyspark.sql import functions as F

from ledgerlens.functions.clean import promo_count_profile, promo_count_raw
from ledgerlens.operators import percentiles as P
from ledgerlens.operators import quality as Q
from ledgerlens.plans.catalog import QUERIES, _orders


def test_m16_raw_promo_count(spark):
    texts = [None, "", "  ", "a", "a,", "a,,b", "a,a", " a , b "]
    df = spark.createDataFrame([(t,) for t in texts], "p string")
    got = [r[0] for r in df.select(promo_count_raw("p")).collect()]
    assert got == [0, 0, 0, 1, 2, 3, 2, 2]
    prof = [r[0] for r in df.select(promo_count_profile("p")).collect()]
    assert prof == [0, 0, 0, 1, 1, 2, 2, 2]


def _orders_df(spark, counts, amounts=None, sku="S", month=4):
    amounts = amounts or [float(i) for i in range(len(counts))]
    rows = [(f"o{i}", sku, month, a, c) for i, (c, a) in enumerate(zip(counts, amounts))]
    return spark.createDataFrame(
        rows, "order_id string, sku string, month int, amount double, promo_count int")


def test_m17_nearest_rank(spark):
    o = _orders_df(spark, list(range(1, 11)))
    for fn in (P.threshold_exact, P.threshold_disc, P.threshold_approx):
        r = fn(o).collect()[0]
        assert (r.p80, r.p90) == (8, 9), fn.__name__


def test_small_groups_nearest_rank(spark):
    o = _orders_df(spark, [1, 2, 3])
    r = P.threshold_exact(o).collect()[0]
    assert (r.p80, r.p90) == (3, 3)


def test_m18_equal_counts_all_qualify(spark):
    o = _orders_df(spark, [2] * 5, [1.0, 2.0, 3.0, 4.0, 5.0])
    r = P.percentile_stddev(o).collect()[0]
    assert r.orders_p80_exact == 5 and r.orders_p90_approx == 5
    assert abs(r.stddev_p80_exact - 2 ** 0.5) < 1e-12


def test_m19_zero_stddev_classes(spark):
    one = _orders_df(spark, [0, 0, 0, 0, 5], sku="A")                       # 1 qualifying
    two = _orders_df(spark, [0, 0, 0, 5, 5], [1.0, 2.0, 3.0, 7.5, 7.5], sku="B")  # 2 equal
    w = P.percentile_stddev(one.unionByName(two))
    got = {r.sku: r for r in w.collect()}
    assert got["A"].orders_p90_exact == 1 and got["A"].stddev_p90_exact == 0.0
    assert got["B"].orders_p90_exact == 2 and got["B"].stddev_p90_exact == 0.0
    z = {(r.method, r.percentile): r for r in Q.zero_breakdown(w).collect()}
    assert z[("exact", "P90")].zero_due_to_lt2_qualifying_orders == 1
    assert z[("exact", "P90")].zero_with_at_least_2_qualifying_orders == 1


def test_moment_combination_equals_direct_stddev(spark):
    # differential: moments over the frequency table against plain Python over the lines
    import math
    import statistics
    for sf in ("0.001", "0.01"):
        groups = {}
        for r in _orders(spark, SF[sf]).collect():
            groups.setdefault((r.sku, r.month), []).append((r.promo_count, r.amount))
        for r in P.percentile_stddev(_orders(spark, SF[sf])).collect():
            rows = groups.pop((r.sku, r.month))
            counts = sorted(c for c, _ in rows)
            assert r.total_orders == len(rows)
            for p, t, n, sd in ((8, r.threshold_p80_exact, r.orders_p80_exact, r.stddev_p80_exact),
                                (9, r.threshold_p90_exact, r.orders_p90_exact, r.stddev_p90_exact)):
                assert t == counts[-(-len(counts) * p // 10) - 1]
                above = [a for c, a in rows if c >= t]
                assert n == len(above)
                want = statistics.pstdev(above) if n > 1 else 0.0
                assert math.isclose(sd, want, rel_tol=1e-6, abs_tol=1e-6)
        assert not groups


def test_total_and_null_keys_do_not_depend_on_methods(spark):
    rows = [("o1", None, 1, 5.0, 1), ("o2", None, 1, None, 2), ("o3", None, 1, 7.0, 3),
            ("o4", "S", None, 1.0, 1)]
    o = spark.createDataFrame(rows, "order_id string, sku string, month int, amount double, promo_count int")
    given = P.threshold_approx(o)
    for kw in (dict(), dict(methods=("exact",)), dict(methods=("approx",)), dict(approx=given)):
        got = {(r.sku, r.month): r.total_orders for r in P.percentile_stddev(o, **kw).collect()}
        assert got == {(None, 1): 3, ("S", None): 1}, kw


def test_exact_disc_approx_agree_on_small_groups(spark):
    o = _orders(spark, SF["0.01"])
    e = P.threshold_exact(o)
    for other in (P.threshold_disc(o), P.threshold_approx(o)):
        assert e.exceptAll(other).count() == 0


def test_invariants_hold(spark):
    w = QUERIES["percentile_stddev"](spark, SF["0.01"])
    assert all(r.violations == 0 for r in Q.validate_result(w).collect())


def test_column_order_follows_reference(spark):
    w = QUERIES["percentile_stddev"](spark, SF["0.001"])
    assert w.columns[:3] == ["sku", "month", "total_orders"]
    assert w.columns[3:6] == ["threshold_p80_approx", "orders_p80_approx", "stddev_p80_approx"]
    assert w.columns[-3:] == ["threshold_p90_exact", "orders_p90_exact", "stddev_p90_exact"]
    assert len(w.columns) == 15
