"""Every comparison report on a result whose differences are known."""

from ledgerlens.operators import compare as C


def wide(spark):
    # (sku, thresholds approx/exact p80, p90; orders; stddevs)
    rows = [("a", 2, 2, 3, 3, 5, 5, 2, 2, 1.0, 1.0, 0.5, 0.5),
            ("b", 3, 2, 3, 4, 4, 5, 3, 2, 1.5, 1.0, 0.5, 0.7),
            ("c", 1, 4, 4, 4, 9, 5, 2, 2, 1.0, 1.0 + 1e-12, 0.5, 0.5 + 1e-7),
            ("d", 2, 2, 9, 3, 5, 5, 0, 2, 1.0, 1.0, None, 0.5)]
    cols = ("sku string, threshold_p80_approx int, threshold_p80_exact int, threshold_p90_approx int, "
            "threshold_p90_exact int, orders_p80_approx long, orders_p80_exact long, "
            "orders_p90_approx long, orders_p90_exact long, stddev_p80_approx double, "
            "stddev_p80_exact double, stddev_p90_approx double, stddev_p90_exact double")
    return spark.createDataFrame(rows, cols).selectExpr("sku", "1 AS month", "10L AS total_orders", "*") \
        .select("month", "total_orders", *[c.split()[0] for c in cols.split(", ")])


def test_threshold_diff_and_top(spark):
    a = spark.createDataFrame([("x", 1, 5, 1), ("y", 1, 2, 9), (None, 1, 1, 1)], "sku string, month int, p80 int, p90 int")
    e = spark.createDataFrame([("x", 1, 3, 1), ("y", 1, 5, 7), (None, 1, 2, 1)], "sku string, month int, p80 int, p90 int")
    diff = C.threshold_diff(a, e)
    assert {r.sku: (r.p80_diff, r.p90_diff) for r in diff.collect()} == {
        "x": (2, 0), "y": (-3, 2), None: (-1, 0)}
    assert [r.sku for r in C.top_threshold_mismatches(diff, "p80", 2).collect()] == ["y", "x"]
    assert [r.sku for r in C.top_threshold_mismatches(diff, "p90", 5).collect()] == ["y"]


def test_accuracy(spark):
    got = {r.percentile: r for r in C.threshold_accuracy(wide(spark)).collect()}
    p80, p90 = got["P80"], got["P90"]
    assert (p80.num_groups, p80.num_threshold_mismatch, p80.mismatch_rate_percent) == (4, 2, 50.0)
    assert (p80.mean_abs_threshold_diff, p80.max_abs_threshold_diff) == (1.0, 3)
    assert (p80.min_signed_diff, p80.max_signed_diff) == (-3, 1)
    assert (p90.min_signed_diff, p90.max_signed_diff, p90.max_abs_threshold_diff) == (-1, 6, 6)


def test_mismatch_union(spark):
    rows = C.mismatch_union(wide(spark)).collect()
    assert sorted((r.percentile, r.sku, r.abs_threshold_diff) for r in rows) == [
        ("P80", "b", 1), ("P80", "c", 3), ("P90", "b", 1), ("P90", "d", 6)]
    assert [(r.percentile, r.sku) for r in C.mismatch_union(wide(spark), k=3).collect()] == [
        ("P80", "c"), ("P80", "b"), ("P90", "d")]


def test_drift_rejects_nulls_and_rounds(spark):
    got = sorted((r.percentile, r.sku) for r in C.result_drift(wide(spark)).collect())
    # c at P90 differs in the 7th place only; d at P90 by its count, its stddev is null
    assert got == [("P80", "b"), ("P80", "c"), ("P90", "b"), ("P90", "d")]


def test_diff_groups_and_summary(spark):
    got = {(r.percentile, r.sku): (r.qualifying_count_diff, r.stddev_diff)
           for r in C.diff_groups(wide(spark)).collect()}
    assert set(got) == {("P80", "b"), ("P80", "c"), ("P90", "b"), ("P90", "c"), ("P90", "d")}
    assert got[("P80", "b")] == (-1, 0.5) and got[("P90", "d")] == (-2, None)
    s = {r.percentile: r for r in C.qualifying_diff_summary(wide(spark)).collect()}["P80"]
    assert (s.groups_with_different_qualifying_count, s.max_abs_qualifying_count_diff) == (2, 4)
    assert s.mean_abs_qualifying_count_diff == 1.25 and s.groups_with_different_stddev == 1
    assert s.max_abs_stddev_diff == 0.5
