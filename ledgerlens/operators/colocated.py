"""The sales jobs over tables whose rows already lie where they are needed.

Order lines are written once in buckets, and sorted within them: by order for the jobs that
bring an order's lines together, by (SKU, month) for the percentile job.  Spark then plans
their aggregations and joins on these keys without an exchange, run after run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import percentiles, promotions
from ledgerlens.sources.sinks import stored, write_bucketed

BUCKETS = 64


def lines_by_order(sales: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    return write_bucketed(sales, "lines_by_order", ["order_id"], buckets)


def lines_by_group(sales: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The percentile job's lines, in buckets by (SKU, month)."""
    return write_bucketed(percentiles.promo_orders(sales), "lines_by_group",
                          ["sku", "month"], buckets, ["sku", "month", "promo_count"])


def percentile_stddev(by_group: DataFrame) -> DataFrame:
    """``percentiles.percentile_stddev`` over ``lines_by_group``: neither the moments nor the
    sketches nor their join shuffle anything."""
    return percentiles.percentile_stddev(by_group, null_keys=False)


def qualification_rate(by_order: DataFrame) -> DataFrame:
    """``promotions.qualification_rate`` over ``lines_by_order``.

    The pairs of an order and its promotions are made, counted and joined to the base lines
    inside the buckets.  The valid promotions are stored first: Spark knows their size then,
    and broadcasts them only if they are small; else the pairs are shuffled to them."""
    valid = stored(promotions.valid_promotions(by_order), "valid-promotions").select("promotion_id")
    good = (promotions.order_promotions(by_order).join(valid, "promotion_id", "left_semi")
            .groupBy("order_id").agg(F.count(F.lit(1)).alias("valid_promo_count"))
            .filter(F.col("valid_promo_count") >= promotions.MIN_VALID_PROMOS)
            .select("order_id", F.lit(True).alias("promo_ok")))
    flagged = promotions.cancelled_standard_base(by_order).join(good, "order_id", "left")
    return promotions.rate_by_city(flagged, promotions.state_avg_amount(by_order))
