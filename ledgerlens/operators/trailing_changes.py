"""Trailing-window mode by enter and leave events, for windows of any length.

``trailing.trailing_mode`` copies each reduced row to every target day it counts for, which
is right for a week and wrong for half a year.  Here n lines of day D enter on day D + 1
and leave on day D + days + 1: two events, whatever the length.

1. Lines are reduced to (key, day, value, count) with map-side combine, then to the sum of
   events per (key, value, day).
2. The running sum per (key, value) gives intervals with a constant count.
3. The largest count over the intervals of a key is looked up through a binary tree over
   the calendar: an interval is the union of at most two nodes on each of the
   tree's levels, a node keeps the best of its intervals, and a day is covered by its node of
   each level.  Between two change points of a key nothing changes, so only the days of
   change points are looked up.

All tables up to the change points are bounded by keys, values and calendar days; nothing in
the plan depends on ``days``.  Only the daily report repeats a result for the days until the
next change.  The windows run over the calendar days of one (key, value), or of one key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.trailing import shipped_lines

LEVELS = 22         # 2 ** 22 days are more than Spark's calendar


def _events(daily: DataFrame, keys, day, value, days: int) -> DataFrame:
    """(keys..., value, at, delta): day numbers on which counts change."""
    at = F.unix_date(day)
    both = F.array(F.struct((at + 1).alias("at"), F.col("cnt").alias("delta")),
                   F.struct((at + (days + 1)).alias("at"), (-F.col("cnt")).alias("delta")))
    return (daily.select(*keys, value, F.inline(both))
            .groupBy(*keys, value, "at").agg(F.sum("delta").alias("delta"))
            .filter(F.col("delta") != 0))


def _shift(x, k):
    return F.call_function("shiftright", x, k)


def _nodes(start, stop):
    """The tree nodes (level, node) whose union is the day numbers [start, stop)."""
    def at(k):
        lo = _shift(start + F.call_function("shiftleft", F.lit(1), k) - 1, k)
        hi = _shift(stop, k)

        def node(odd, n):
            # the last bit: days before 1970 have negative numbers
            return F.when((lo < hi) & (odd.bitwiseAND(F.lit(1)) == 1), F.struct(k.alias("level"), n.alias("node")))
        return F.array(node(lo, lo), node(hi, hi - 1))
    # above the interval's own length there is nothing
    top = F.floor(F.log2(stop - start)).cast("int")
    levels = F.sequence(F.lit(0), top)
    return F.filter(F.flatten(F.transform(levels, at)), lambda x: x.isNotNull())


def mode_changes(df: DataFrame, keys=("state",), day="day", value="size",
                 days: int = 7) -> DataFrame:
    """(keys..., valid_from, valid_to, top_<value>, <value>_count): the most frequent value
    of the ``days`` days before each target day from valid_from to valid_to, both included;
    ties go to the smallest value.  Neighbouring rows of a key may carry the same result."""
    keys = list(keys)
    daily = df.groupBy(*keys, day, value).agg(F.count(F.lit(1)).alias("cnt"))
    events = _events(daily, keys, day, value, days)
    # struct keys: null parts are groups like any other
    events = events.select(F.struct(*keys).alias("_key"), F.col(value).alias("_value"),
                           "at", "delta")
    w = Window.partitionBy("_key", "_value").orderBy("at")
    steps = events.select(
        "_key", "_value", "at", F.lead("at").over(w).alias("until"),
        F.sum("delta").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        .alias("cnt")).filter("cnt > 0")
    nodes = (steps.select("_key", "_value", "cnt", F.inline(_nodes(F.col("at"), F.col("until"))))
             .groupBy("_key", "level", "node")
             .agg(F.min(F.struct((-F.col("cnt")).alias("neg"), F.col("_value").alias("v")))
                  .alias("best")))
    changes = events.select("_key", "at").distinct()
    changes = changes.withColumn("until", F.lead("at").over(
        Window.partitionBy("_key").orderBy("at"))).filter("until IS NOT NULL")
    levels = F.sequence(F.lit(0), F.lit(LEVELS))
    asked = changes.select("_key", "at", "until", F.explode(F.transform(
        levels, lambda k: F.struct(k.alias("level"), _shift(F.col("at"), k).alias("node"))))
        .alias("n")).select("_key", "at", "until", "n.level", "n.node")
    top = (asked.join(nodes, ["_key", "level", "node"])
           .groupBy("_key", "at", "until").agg(F.min("best").alias("best")))
    return top.select(*[F.col(f"_key.`{k}`").alias(k) for k in keys],
                      F.date_from_unix_date("at").alias("valid_from"),
                      F.date_from_unix_date(F.col("until") - 1).alias("valid_to"),
                      F.col("best.v").alias("top_" + value),
                      (-F.col("best.neg")).alias(value + "_count"))


def trailing_mode_by_changes(df: DataFrame, keys=("state",), day="day", value="size",
                             days: int = 7) -> DataFrame:
    """As ``trailing.trailing_mode``: (keys..., target_date, top_<value>, <value>_count)."""
    keys = list(keys)
    return (mode_changes(df, keys, day, value, days)
            .select(*keys, F.explode(F.sequence("valid_from", "valid_to")).alias("target_date"),
                    "top_" + value, value + "_count"))


def merged_changes(changes: DataFrame, keys=("state",), value="size") -> DataFrame:
    """The same intervals, with neighbours of equal result made one (a window over the
    change points of a key)."""
    keys = list(keys)
    w = Window.partitionBy(*keys).orderBy("valid_from")
    same = [F.col(c).eqNullSafe(F.lag(c).over(w)) for c in ("top_" + value, value + "_count")]
    new = ~(same[0] & same[1] & (F.date_add(F.lag("valid_to").over(w), 1) == F.col("valid_from")))
    runs = (changes.withColumn("_new", F.coalesce(new, F.lit(True)).cast("int"))
            .withColumn("_run", F.sum("_new").over(w)))
    return (runs.groupBy(*keys, "_run").agg(
        F.min("valid_from").alias("valid_from"), F.max("valid_to").alias("valid_to"),
        F.first("top_" + value).alias("top_" + value),
        F.first(value + "_count").alias(value + "_count")).drop("_run"))


def size_mode_by_changes(sales: DataFrame, days: int) -> DataFrame:
    """The sales report's query over windows of ``days`` days."""
    return trailing_mode_by_changes(shipped_lines(sales), ("state",), "day", "size", days)


def size_mode_change_points(sales: DataFrame, days: int) -> DataFrame:
    """The same as intervals: one row per state and constant result."""
    return merged_changes(mode_changes(shipped_lines(sales), ("state",), "day", "size", days))
