"""Approximate-versus-exact comparison reports over the percentile results.

All of them work on the per-group tables (thresholds or the wide result), so
their size follows the number of groups, never the number of lines.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.percentiles import GROUP_KEYS, LEVELS

LEVEL_NAMES = tuple(name for name, _ in LEVELS)


def threshold_diff(approx: DataFrame, exact: DataFrame, keys=GROUP_KEYS,
                   levels=LEVEL_NAMES) -> DataFrame:
    """keys, <level>_approx, <level>_exact, <level>_diff (approx - exact)."""
    keys = list(keys)
    a = approx.select(*keys, *[F.col(l).alias(f"{l}_approx") for l in levels])
    e = exact.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
                     *[F.col(l).alias(f"{l}_exact") for l in levels])
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
    j = a.join(e, same)                     # null keys are groups like any other
    return j.select(*keys, *[c for l in levels for c in (
        F.col(f"{l}_approx"), F.col(f"{l}_exact"),
        (F.col(f"{l}_approx") - F.col(f"{l}_exact")).alias(f"{l}_diff"))])


def top_threshold_mismatches(diff: DataFrame, level: str, k: int = 20,
                             keys=GROUP_KEYS) -> DataFrame:
    """Top-k groups whose <level> thresholds differ, by absolute difference
    (ties broken by the group keys)."""
    d = F.col(f"{level}_diff")
    return (diff.filter(F.col(f"{level}_approx") != F.col(f"{level}_exact"))
            .orderBy(F.abs(d).desc(), *[F.col(c).asc() for c in keys])
            .limit(k))


def _long_by_level(wide: DataFrame, levels, cols_for, keys=GROUP_KEYS) -> DataFrame:
    """Unpivot the wide result into one row per (group, level); the result is computed
    once, not once per level."""
    names = [dst for dst, _ in cols_for(levels[0])]
    rows = ", ".join(f"'{l.upper()}', " + ", ".join(f"`{src}`" for _, src in cols_for(l))
                     for l in levels)
    return wide.select(*keys, F.expr(f"stack({len(levels)}, {rows}) "
                                     f"AS (percentile, {', '.join(names)})")).select(
        "percentile", *keys, *names)


def threshold_accuracy(wide: DataFrame, levels=LEVEL_NAMES) -> DataFrame:
    """Per percentile level: groups, mismatching thresholds, mismatch rate in
    percent, mean/max absolute and min/max signed threshold difference."""
    long = _long_by_level(wide, levels, lambda l: [
        ("a", f"threshold_{l}_approx"), ("e", f"threshold_{l}_exact")])
    d = F.col("a") - F.col("e")
    return (long.groupBy("percentile").agg(
        F.count(F.lit(1)).alias("num_groups"),
        F.count_if(d != 0).alias("num_threshold_mismatch"),
        (F.avg(F.when(d != 0, 1.0).otherwise(0.0)) * 100).alias("mismatch_rate_percent"),
        F.avg(F.abs(d).cast("double")).alias("mean_abs_threshold_diff"),
        F.max(F.abs(d)).alias("max_abs_threshold_diff"),
        F.min(d).alias("min_signed_diff"),
        F.max(d).alias("max_signed_diff")))


def mismatch_union(wide: DataFrame, levels=LEVEL_NAMES, k: int | None = None,
                   keys=GROUP_KEYS) -> DataFrame:
    """P80 and P90 threshold mismatches in one list: all of them, or for a display
    the first k by percentile and descending absolute difference."""
    long = _long_by_level(wide, levels, lambda l: [
        ("total_orders", "total_orders"),
        ("threshold_approx", f"threshold_{l}_approx"),
        ("threshold_exact", f"threshold_{l}_exact")])
    rows = (long.filter(F.col("threshold_approx") != F.col("threshold_exact"))
            .withColumn("abs_threshold_diff",
                        F.abs(F.col("threshold_approx") - F.col("threshold_exact"))))
    if k is None:
        return rows
    return rows.orderBy(F.asc("percentile"), F.desc("abs_threshold_diff"),
                        *[F.asc(c) for c in keys]).limit(k)


def result_drift(wide: DataFrame, levels=LEVEL_NAMES, digits: int = 6) -> DataFrame:
    """Groups whose qualifying counts differ between methods, or whose stddev
    differs after rounding to ``digits`` places (null-rejecting, like the
    reference's comparison)."""
    long = _long_by_level(wide, levels, lambda l: [
        ("orders_approx", f"orders_{l}_approx"), ("orders_exact", f"orders_{l}_exact"),
        ("stddev_approx", f"stddev_{l}_approx"), ("stddev_exact", f"stddev_{l}_exact")])
    return long.filter(
        (F.col("orders_approx") != F.col("orders_exact"))
        | (F.round("stddev_approx", digits) != F.round("stddev_exact", digits)))


def qualifying_diff_summary(wide: DataFrame, levels=LEVEL_NAMES,
                            tol: float = 1e-9) -> DataFrame:
    """Per level: groups with different qualifying counts / stddev (absolute
    tolerance ``tol``), mean and max absolute differences."""
    long = _long_by_level(wide, levels, lambda l: [
        ("oa", f"orders_{l}_approx"), ("oe", f"orders_{l}_exact"),
        ("sa", f"stddev_{l}_approx"), ("se", f"stddev_{l}_exact")])
    cd = F.col("oa") - F.col("oe")
    sd = F.abs(F.col("sa") - F.col("se"))
    return long.groupBy("percentile").agg(
        F.count_if(cd != 0).alias("groups_with_different_qualifying_count"),
        F.avg(F.abs(cd).cast("double")).alias("mean_abs_qualifying_count_diff"),
        F.max(F.abs(cd)).alias("max_abs_qualifying_count_diff"),
        F.count_if(sd > tol).alias("groups_with_different_stddev"),
        F.avg(sd).alias("mean_abs_stddev_diff"),
        F.max(sd).alias("max_abs_stddev_diff"))


def diff_groups(wide: DataFrame, levels=LEVEL_NAMES, tol: float = 1e-9) -> DataFrame:
    """Groups whose qualifying count differs between methods or whose stddev
    differs by more than ``tol`` (absolute), with both thresholds, counts,
    stddevs and the signed differences."""
    long = _long_by_level(wide, levels, lambda l: [
        ("total_orders", "total_orders"),
        ("threshold_approx", f"threshold_{l}_approx"), ("threshold_exact", f"threshold_{l}_exact"),
        ("orders_approx", f"orders_{l}_approx"), ("orders_exact", f"orders_{l}_exact"),
        ("stddev_approx", f"stddev_{l}_approx"), ("stddev_exact", f"stddev_{l}_exact")])
    cd = F.col("orders_approx") - F.col("orders_exact")
    sd = F.col("stddev_approx") - F.col("stddev_exact")
    return (long.withColumn("qualifying_count_diff", cd).withColumn("stddev_diff", sd)
            .filter((F.col("qualifying_count_diff") != 0) | (F.abs(F.col("stddev_diff")) > tol)))
