"""Trailing-window mode: the most frequent value per key over the previous
``days`` days (target day excluded).

A line on day D belongs to target days D+1 .. D+days.  Per (key, target) the
lines are counted per value and the value with the highest count is returned
(ties: smallest value text).  Targets exist only where the window holds at
least one line.

Plan: lines are first reduced to (key, day, value, count) with map-side
combine -- the only shuffle that sees the raw rows.  The fan-out to target
days runs on that reduced table, whose size is bounded by
keys x calendar days x values, not by the number of lines.  The top value is
an aggregate (``min`` of a (-count, value) struct), so a hot key is combined
map-side as well; no window sort over a partition is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions.clean import contains_ci, int_or_zero, is_blank, jvm_trim, norm_state, valid_state


def shipped_lines(sales: DataFrame) -> DataFrame:
    """Lines of the trailing-window job: status contains "shipped" (any case),
    qty > 0, valid state, non-blank size (case kept), valid date."""
    return (sales
            .filter(contains_ci("status", "shipped") & (int_or_zero("qty") > 0)
                    & valid_state("state") & ~is_blank("size")
                    & F.col("order_date").isNotNull())
            .select(norm_state("state").alias("state"),
                    F.col("order_date").alias("day"),
                    jvm_trim("size").alias("size")))


def _top1(counts: DataFrame, keys, value, cnt) -> DataFrame:
    best = F.min(F.struct((-F.col(cnt)).alias("neg"), F.col(value).alias("v")))
    return (counts.groupBy(*keys).agg(best.alias("b"))
            .select(*keys, F.col("b.v").alias("top_" + value),
                    (-F.col("b.neg")).alias(value + "_count")))


def trailing_mode(df: DataFrame, keys=("state",), day="day", value="size",
                  days: int = 7) -> DataFrame:
    """Generic operator: (keys..., target_date, top_<value>, <value>_count)."""
    keys = list(keys)
    daily = df.groupBy(*keys, day, value).agg(F.count(F.lit(1)).alias("cnt"))
    fanned = daily.select(
        *keys, value, "cnt",
        F.explode(F.sequence(F.lit(1), F.lit(days))).alias("k"),
        F.col(day))
    fanned = fanned.select(*keys, value, "cnt",
                           F.date_add(F.col(day), F.col("k")).alias("target_date"))
    counts = (fanned.groupBy(*keys, "target_date", value)
              .agg(F.sum("cnt").alias("cnt")))
    return _top1(counts, keys + ["target_date"], value, "cnt")


def trailing_mode_window_fn(df: DataFrame, keys=("state",), day="day",
                            value="size", days: int = 7) -> DataFrame:
    """Same result through Spark's sliding ``window``: a window
    [start, start + days) with a 1-day slide; the target day is its end.
    Days become zone-less timestamps (``timestamp_ntz``), so the windows align
    to calendar days whatever the session time zone is."""
    keys = list(keys)
    daily = df.groupBy(*keys, day, value).agg(F.count(F.lit(1)).alias("cnt"))
    win = F.window(F.col(day).cast("timestamp_ntz"), f"{days} days", "1 day")
    counts = (daily.groupBy(*keys, win.alias("w"), value)
              .agg(F.sum("cnt").alias("cnt"))
              .select(*keys, F.col("w.end").cast("date").alias("target_date"),
                      value, "cnt"))
    return _top1(counts, keys + ["target_date"], value, "cnt")


def size_mode_by_state(sales: DataFrame, days: int = 7) -> DataFrame:
    """The sales report's query: most-bought size per state over the 7 days
    before each target day: (state, target_date, top_size, size_count)."""
    return trailing_mode(shipped_lines(sales), ("state",), "day", "size", days)


def size_mode_by_state_window_fn(sales: DataFrame, days: int = 7) -> DataFrame:
    return trailing_mode_window_fn(shipped_lines(sales), ("state",), "day", "size", days)


# Header and date text of the trailing-window CSV report.
REPORT_HEADER = ("State", "TargetDate", "MostBoughtSize", "Count")
REPORT_DATE_FORMAT = "MM-dd-yy"


def as_report(result: DataFrame) -> DataFrame:
    """Text layout of the CSV report: State, TargetDate (MM-dd-yy),
    MostBoughtSize, Count."""
    s, t, v, c = REPORT_HEADER
    return result.select(F.col("state").alias(s),
                         F.date_format("target_date", REPORT_DATE_FORMAT).alias(t),
                         F.col("top_size").alias(v), F.col("size_count").alias(c))
