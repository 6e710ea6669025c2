"""Rule-based qualification rate over a multi-valued promotion column.

1. A promotion is valid when its last and first order dates are >= 2 days
   apart.
2. An order qualifies on promotions when it carries >= 3 distinct valid
   promotions over all its lines.
3. State average amount over Merchant-fulfilled, courier-shipped lines.
4. Base lines: Cancelled, Standard service level, non-blank city.
5. Qualified: base lines with amount strictly below their state's average and
   whose order qualifies on promotions.
6. Per city: qualified / base lines as a percentage, rounded to 2 places; 0
   when none qualify (cities are kept).

Plan: the promotion list is exploded once and reduced to (order, promotion)
pairs with their first and last date; validity is an aggregation of these
pairs, the left-semi join against the valid set reads the same exchange, and
base lines meet the qualifying orders before the per-state averages.  Both
small sides (valid promotions, state averages) are aggregates whose size is
only known at run time; if AQE has measured them before their join starts, it
broadcasts them when they are under its threshold; otherwise the join stays sort-merge with skewed
partitions split.  Numerator and denominator come out of one aggregation per
city.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MIN_ACTIVE_DAYS = 2
MIN_VALID_PROMOS = 3


def _nonblank(c):
    return F.col(c).isNotNull() & (F.trim(F.col(c)) != F.lit(""))


def promotion_tokens(sales: DataFrame) -> DataFrame:
    """(order_id, order_date, promotion_id) per promotion token; tokens are
    trimmed, blank tokens kept (they never become valid)."""
    return (sales.filter(_nonblank("promotion_ids"))
            .select("order_id", "order_date",
                    F.explode(F.split("promotion_ids", ",")).alias("tok"))
            .select("order_id", "order_date", F.trim("tok").alias("promotion_id")))


def valid_promotions(sales: DataFrame, min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """(promotion_id, first_seen, last_seen, active_days) with
    active_days >= min_days."""
    return _valid(order_promotions(sales), min_days)


def order_promotions(sales: DataFrame) -> DataFrame:
    """(order_id, promotion_id, first_seen, last_seen) per order and promotion."""
    return (promotion_tokens(sales).filter(F.col("promotion_id") != "")
            .groupBy("order_id", "promotion_id")
            .agg(F.min("order_date").alias("first_seen"),
                 F.max("order_date").alias("last_seen")))


def _valid(pairs: DataFrame, min_days: int) -> DataFrame:
    return (pairs.groupBy("promotion_id")
            .agg(F.min("first_seen").alias("first_seen"),
                 F.max("last_seen").alias("last_seen"))
            .withColumn("active_days", F.datediff("last_seen", "first_seen"))
            .filter(F.col("active_days") >= min_days))


def orders_with_valid_promos(sales: DataFrame, min_promos: int = MIN_VALID_PROMOS,
                             min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """(order_id, valid_promo_count) for orders with >= min_promos distinct
    valid promotions across all their lines."""
    pairs = order_promotions(sales)
    valid = _valid(pairs, min_days).select("promotion_id")
    # Counting the surviving pairs per order is the distinct count.  A pair without
    # any date cannot be valid; asking for one also keeps both uses of the pairs
    # alike, so that their one exchange is shared.
    dated = pairs.filter(F.col("first_seen") <= F.col("last_seen"))
    return (dated.join(valid, "promotion_id", "left_semi")
            .groupBy("order_id")
            .agg(F.count(F.lit(1)).alias("valid_promo_count"))
            .filter(F.col("valid_promo_count") >= min_promos))


def state_avg_amount(sales: DataFrame) -> DataFrame:
    """(state, avg_amount) over Merchant / Shipped lines with a non-blank
    state; state is upper(trim(.))."""
    return (sales
            .filter((F.col("fulfilment") == "Merchant")
                    & (F.col("courier_status") == "Shipped") & _nonblank("state"))
            .groupBy(F.upper(F.trim("state")).alias("state"))
            .agg(F.avg("amount").alias("avg_amount")))


def cancelled_standard_base(sales: DataFrame) -> DataFrame:
    """Base lines: (order_id, amount, state, city) of Cancelled, Standard
    lines with a non-blank city; state and city upper(trim(.))."""
    return (sales
            .filter((F.col("status") == "Cancelled")
                    & (F.col("service_level") == "Standard") & _nonblank("city"))
            .select("order_id", "amount",
                    F.upper(F.trim("state")).alias("state"),
                    F.upper(F.trim("city")).alias("city")))


def base_counts(sales: DataFrame) -> DataFrame:
    """(city, base_count): denominator per city (non-null order ids)."""
    return (cancelled_standard_base(sales).groupBy("city")
            .agg(F.count("order_id").alias("base_count")))


def qualification_rate(sales: DataFrame, min_promos: int = MIN_VALID_PROMOS,
                       min_days: int = MIN_ACTIVE_DAYS) -> DataFrame:
    """(city, base_count, qualified_count, pct_qualified)."""
    base = cancelled_standard_base(sales)
    avgs = state_avg_amount(sales)
    good = (orders_with_valid_promos(sales, min_promos, min_days)
            .select("order_id", F.lit(True).alias("promo_ok")))
    # order_id first (that shuffle is needed anyway); the averages, one row per
    # state, are then usually measured and broadcast.  Where they are not ready in
    # time the join shuffles by state, and AQE splits the hot states.
    return rate_by_city(base.join(good, "order_id", "left"), avgs)


def rate_by_city(flagged: DataFrame, avgs: DataFrame) -> DataFrame:
    """(city, base_count, qualified_count, pct_qualified) from base lines with ``promo_ok``."""
    flagged = flagged.join(avgs, "state", "left")
    qualified = (F.col("amount") < F.col("avg_amount")) & F.col("promo_ok")
    counts = flagged.groupBy("city").agg(
        F.count("order_id").alias("base_count"),
        F.count(F.when(qualified, F.col("order_id"))).alias("qualified_count"))
    pct = F.round(F.try_divide(F.col("qualified_count"), F.col("base_count")) * 100, 2)
    return counts.select("city", "base_count", "qualified_count",
                         pct.alias("pct_qualified"))
