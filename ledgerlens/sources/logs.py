"""Text-log sources.

``read_log_text`` is the plain text scan.  ``event_run_log`` renders the
``events`` table as a job log -- one timing line per event, with an
unrelated line for error events -- so the run-time reports are exercised on
data whose size follows the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the rendered log: the event type whose lines are noise.
NOISE_EVENT_TYPE = "error"
TIMED_EVENT_TYPES = ("click", "purchase", "signup", "view")


def read_log_text(spark: SparkSession, path: str) -> DataFrame:
    """(value, file, block, pos) per line: the text, its file, the start of the block
    that a task read it from, and its place among the lines of that read."""
    return spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"))


def event_run_log(events: DataFrame) -> DataFrame:
    """(line, value): ``[<event_type>] Run <event_id>: <value * 100> ms`` per event, or
    ``WARN user <user_id> <props>`` for error events; line is the event id, the
    order of the log."""
    timed = F.format_string("[%s] Run %d: %d ms", F.col("event_type"),
                            F.col("event_id"),
                            F.round(F.col("value") * 100).cast("bigint"))
    noise = F.format_string("WARN user %d %s", F.col("user_id"), F.col("props"))
    return events.select(
        F.col("event_id").alias("line"), F.when(F.col("event_type") == NOISE_EVENT_TYPE, noise)
         .otherwise(timed).alias("value"))


def event_runtime_lines(events: DataFrame) -> DataFrame:
    """(event_id, value): one run time in seconds per line (the event's value) -- the
    layout of a benchmark's run-time file, with the column that orders it."""
    return events.select("event_id", F.format_string("%.2f", F.col("value")).alias("value"))
