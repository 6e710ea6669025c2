"""Median style variety per month and state (two-level aggregation).

Level 1 groups order lines by (month, state, style): variety is the number of
distinct SKUs over all sizes, and the group survives only if any of its lines
has a big size.  Level 2 takes the exact median of variety per (month, state).

Plan: the distinct count is planned by Spark as an aggregation on
(month, state, style, sku) with map-side combine, then a partial count per
(month, state, style), so a hot style is spread over the sku hash partitions
instead of landing in one task.  The median's buffer is a value -> count map,
so its size is bounded by the distinct varieties, not by the rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.clean import BIG_SIZES, is_blank, jvm_trim, norm_state, valid_state


def variety_input(sales: DataFrame) -> DataFrame:
    """Lines usable by the variety job: valid state, style, sku, size and
    date; no status filter.  Month is ``yyyy-MM`` (years kept apart)."""
    return (sales
            .filter(valid_state("state") & ~is_blank("style") & ~is_blank("sku")
                    & ~is_blank("size") & F.col("order_date").isNotNull())
            .select(F.date_format("order_date", "yyyy-MM").alias("month"),
                    norm_state("state").alias("state"),
                    jvm_trim("style").alias("style"),
                    jvm_trim("sku").alias("sku"),
                    F.upper(jvm_trim("size")).alias("size")))


def style_variety(sales: DataFrame, big_sizes=BIG_SIZES) -> DataFrame:
    """(month, state, style, variety) for styles that sold a big size."""
    lines = variety_input(sales)
    return (lines.groupBy("month", "state", "style")
            .agg(F.count_distinct("sku").alias("variety"),
                 F.coalesce(F.bool_or(F.col("size").isin(*big_sizes)),
                            F.lit(False)).alias("has_big"))
            .filter("has_big")
            .drop("has_big"))


def median_variety(sales: DataFrame, big_sizes=BIG_SIZES) -> DataFrame:
    """(month, state, median_variety): exact median (mean of the two middle
    values for an even count)."""
    return (style_variety(sales, big_sizes)
            .groupBy("month", "state")
            .agg(F.median("variety").cast("double").alias("median_variety")))
