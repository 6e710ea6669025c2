"""Trailing-window mode as an incremental Structured Streaming job.

The same result as ``operators.trailing.trailing_mode`` for every target day
whose window has closed: lines are counted per (key, 7-day window sliding by
one day, value) with a watermark on the line's day, and a second, chained
aggregation keeps the top value per (key, window).  ``row_number`` is not
available on streams, so the top value is ``min(struct(-count, value))``,
which is the same total order as the batch operator (count desc, value asc).

Windows are emitted in append mode once the watermark passes their end; a
line arriving later than ``watermark`` behind the newest day seen is dropped
by Spark (standard late-data semantics).  State is kept per open window and
is bounded by keys x open windows x values, not by lines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def trailing_mode_stream(lines: DataFrame, keys=("state",), day="day",
                         value="size", days: int = 7, *, watermark: str) -> DataFrame:
    """Streaming (keys..., target_date, top_<value>, <value>_count).

    ``watermark`` has no default, as it decides which lines count: it must span the
    disorder of the input (for files that do not come in day order, the whole range
    of days), else late lines are lost.  Windows that the watermark has not passed at
    the end of the input do not appear."""
    keys = list(keys)
    # event time = UTC midnight of the day, built arithmetically so that the
    # windows align to calendar days whatever the session time zone is
    ts = (lines.withColumn("_ts", F.timestamp_seconds(F.unix_date(F.col(day)).cast("bigint") * 86400))
          .withWatermark("_ts", watermark))
    counts = (ts.groupBy(*keys, F.window("_ts", f"{days} days", "1 day").alias("w"), value)
              .agg(F.count(F.lit(1)).alias("cnt")))
    best = F.min(F.struct((-F.col("cnt")).alias("neg"), F.col(value).alias("v")))
    top = counts.groupBy(*keys, "w").agg(best.alias("b"))
    end_day = F.date_from_unix_date((F.unix_seconds(F.col("w.end")) / 86400).cast("int"))
    return top.select(*keys, end_day.alias("target_date"),
                      F.col("b.v").alias("top_" + value),
                      (-F.col("b.neg")).alias(value + "_count"))


def run_available_now(stream: DataFrame, out_path: str, checkpoint_path: str):
    """Drain everything available into a Parquet folder (append mode) and
    stop; the checkpoint makes the job restartable after a failure."""
    q = (stream.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return q
