"""Promotion validity kept up to date day by day, instead of computed anew.

The state is four tables: per promotion its first and last day and whether it is valid; per
(order, promotion) that the order carries it, and whether the promotion was valid when the
pair came; the orders that carry any; per order how many valid promotions it carries.  A day's lines change an order's count in two ways only:

* a pair that the order did not have yet, of a promotion that is valid now, adds one;
* a promotion that becomes valid now adds one for each order that carried it before.

So a step reads the pairs of the promotions that become valid and of the day's orders, and
counts nothing else again: validity is never lost, since the span of days only grows.  Days
may come in any order, and lines may come again.  Old pairs are looked through for two
things.  A pair that the order has already can only be of an order that came before: the
orders, one number each, are matched first, and the pairs of those that come again are all
that new pairs are compared with.  A promotion that becomes valid now has only pairs that
came before it was valid: the others are left out.  So what moves in a step is the day's
pairs, the orders and the pairs of promotions not valid yet, unless most orders come again.
Pairs and orders are appended to; promotions and counts are written anew.  Every step writes tables of its own and names
them in the returned state, so a step that fails leaves the one before as it was.
"""

from __future__ import annotations

import functools
import operator
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators.promotions import MIN_ACTIVE_DAYS, MIN_VALID_PROMOS, order_promotions
from ledgerlens.session import scratch_path
from ledgerlens.sources.sinks import stored


@dataclass
class PromotionState:
    """Names of the state's tables; the pairs are the union of what each step added."""

    promotions: DataFrame | None = None     # promotion_id, first_seen, last_seen, valid
    counts: DataFrame | None = None         # order_id, valid_promo_count
    pair_paths: list[str] = field(default_factory=list)     # order_id, promotion_id, valid
    order_paths: list[str] = field(default_factory=list)    # order_id, each once in all
    changed_orders: int = 0                 # counts that the last step touched

    def pairs(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(*self.pair_paths)


def advance(state: PromotionState, lines: DataFrame,
            min_days: int = MIN_ACTIVE_DAYS) -> PromotionState:
    """The state after some more lines (order_id, order_date, promotion_ids)."""
    spark = lines.sparkSession
    new = stored(order_promotions(lines), "day-pairs")
    seen = new.select("promotion_id", "first_seen", "last_seen", F.lit(False).alias("was"))
    if state.promotions is not None:
        seen = seen.union(state.promotions.select(
            "promotion_id", "first_seen", "last_seen", F.col("valid").alias("was")))
    promotions = (seen.groupBy("promotion_id")
                  .agg(F.min("first_seen").alias("first_seen"),
                       F.max("last_seen").alias("last_seen"), F.max("was").alias("was"))
                  .withColumn("valid", F.coalesce(
                      F.datediff("last_seen", "first_seen") >= min_days, F.lit(False))))
    promotions = stored(promotions, "promotions")
    valid = promotions.filter("valid").select("promotion_id", "valid")
    became = promotions.filter("valid AND NOT was").select("promotion_id")

    orders = _day_orders(spark, state, new)
    order_path = scratch_path(spark, "orders")
    orders.filter("first").select("order_id").write.parquet(order_path)
    pairs = new.select("order_id", "promotion_id")
    added = []
    if state.pair_paths:
        old = state.pairs(spark)
        # both stored: Spark knows their size then, and moves the pairs only if they are large
        again = stored(orders.filter("NOT first").select("order_id"), "orders-again")
        known = stored(_equal(old.select("order_id", "promotion_id"), again, ["order_id"],
                              "left_semi"), "known-pairs")
        pairs = _equal(pairs, known, ["order_id", "promotion_id"], "left_anti")
        added.append(old.filter("NOT valid").join(became, "promotion_id", "left_semi")
                     .select("order_id"))
    path = scratch_path(spark, "order-promotions")
    (pairs.join(valid, "promotion_id", "left")
     .select("order_id", "promotion_id", F.coalesce("valid", F.lit(False)).alias("valid"))
     .write.parquet(path))
    added.append(spark.read.parquet(path).filter("valid").select("order_id"))
    delta = added[0] if len(added) == 1 else added[0].unionByName(added[1])
    delta = stored(delta.groupBy("order_id").agg(F.count(F.lit(1)).alias("more")), "count-changes")
    counts = delta.select("order_id", F.col("more").alias("valid_promo_count"))
    if state.counts is not None:
        counts = (state.counts.unionByName(counts).groupBy("order_id")
                  .agg(F.sum("valid_promo_count").alias("valid_promo_count")))
    return PromotionState(promotions.drop("was"), stored(counts, "order-counts"),
                          [*state.pair_paths, path], [*state.order_paths, order_path],
                          delta.count())


def _day_orders(spark: SparkSession, state: PromotionState, new: DataFrame) -> DataFrame:
    """(order_id, first): the orders of the pairs ``new``, and whether none came before."""
    ids = new.select("order_id", F.lit(True).alias("first"))
    if state.order_paths:
        ids = ids.union(spark.read.parquet(*state.order_paths).select("order_id", F.lit(False)))
    orders = ids.groupBy("order_id").agg(F.min("first").alias("first"), F.max("first").alias("now"))
    return stored(orders.filter("now").select("order_id", "first"), "day-orders")


def _equal(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """``left`` joined to ``right`` where all ``columns`` are equal, or null in both."""
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in columns]
    return left.alias("n").join(right.alias("o"), functools.reduce(operator.and_, same), how)


def qualifying_orders(state: PromotionState, min_promos: int = MIN_VALID_PROMOS) -> DataFrame:
    """(order_id, valid_promo_count), as ``promotions.orders_with_valid_promos``."""
    return state.counts.filter(F.col("valid_promo_count") >= min_promos)


def valid_promotions(state: PromotionState) -> DataFrame:
    """(promotion_id, first_seen, last_seen, active_days), as ``promotions.valid_promotions``."""
    return state.promotions.filter("valid").select(
        "promotion_id", "first_seen", "last_seen",
        F.datediff("last_seen", "first_seen").alias("active_days"))


def replay(batches) -> PromotionState:
    """The state after a series of batches of lines, from nothing."""
    state = PromotionState()
    for lines in batches:
        state = advance(state, lines)
    return state
