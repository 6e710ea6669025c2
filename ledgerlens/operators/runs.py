"""Run-time summaries: parse timing lines out of log text, pivot them to one
column per method, and summarise each method.

The log is read as text lines (``spark.read.text``), so it is split across
tasks like any other file; parsing is ``regexp_extract``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.sources.sinks import stored

# Fixed value: shape of a timing line, e.g. "[approx] Run 3: 1066 ms".
RUN_LINE_PATTERN = r"(?i)\[([a-z_]+)\]\s+Run\s+(\d+)\s*:\s*(\d+)\s*ms"


def parse_run_lines(lines: DataFrame, text_col: str = "value",
                    pattern: str = RUN_LINE_PATTERN) -> DataFrame:
    """(method, run, ms) for every matching line; other lines are ignored.
    A ``line`` column (the order of the log) is carried along if present."""
    t = F.col(text_col)
    keep = [F.col("line")] if "line" in lines.columns else []
    return (lines.filter(t.rlike(pattern))
            .select(F.lower(F.regexp_extract(t, pattern, 1)).alias("method"),
                    F.regexp_extract(t, pattern, 2).cast("bigint").alias("run"),
                    F.regexp_extract(t, pattern, 3).cast("bigint").alias("ms"), *keep))


def runtime_pivot(runs: DataFrame, methods: tuple[str, ...]) -> DataFrame:
    """(run, <method>_ms ...): one row per run, the first value per method --
    the one on the earliest log line when lines are numbered (deterministic).
    The method list is given explicitly so the pivot needs no extra job."""
    pick = F.min_by("ms", "line") if "line" in runs.columns else F.first("ms")
    wide = runs.groupBy("run").pivot("method", list(methods)).agg(pick)
    return wide.select("run", *[F.col(m).alias(f"{m}_ms") for m in methods])


def runtime_summary(runs: DataFrame, baseline: str) -> DataFrame:
    """Per method: runs, mean / population std / min / max in ms, mean in
    seconds and the mean relative to ``baseline``'s mean (2 places)."""
    per = runs.groupBy("method").agg(
        F.count("ms").alias("runs"),
        F.avg("ms").alias("mean_ms"),
        F.stddev_pop("ms").alias("std_ms_population"),
        F.min("ms").alias("min_ms"),
        F.max("ms").alias("max_ms"))
    base = per.filter(F.col("method") == baseline).select("mean_ms").scalar()
    return per.select(
        "method", "runs",
        F.round("mean_ms", 2).alias("mean_ms"),
        F.round("std_ms_population", 2).alias("std_ms_population"),
        "min_ms", "max_ms",
        F.round(F.col("mean_ms") / 1000, 2).alias("mean_seconds"),
        F.round(F.col("mean_ms") / base, 2).alias("relative_to_baseline"))


def run_stats(runs: DataFrame, group: str = "method", value: str = "seconds",
              digits: int = 6) -> DataFrame:
    """Per group: n, mean, *sample* stddev (0.0 when n < 2), min, max, all
    rounded to ``digits`` places."""
    v = F.col(value).cast("double")
    return runs.groupBy(group).agg(
        F.count(v).alias("number_of_runs"),
        F.round(F.avg(v), digits).alias("mean_seconds"),
        F.round(F.when(F.count(v) < 2, F.lit(0.0)).otherwise(F.stddev_samp(v)),
                digits).alias("stddev_seconds"),
        F.round(F.min(v), digits).alias("min_seconds"),
        F.round(F.max(v), digits).alias("max_seconds"))


def number_lines(lines: DataFrame, groups: list, order: list, name: str = "run") -> DataFrame:
    """Add a 1-based, gap-free number in the order of ``groups``, then ``order``.

    ``groups`` are expressions that cut the lines, in order, into pieces a task can
    sort: the file and block of a text line, or ranges of a numeric key.  Lines are
    numbered inside their group and shifted by the size of all groups before.  Those
    offsets are summed in ranges of groups, and shifted by the sizes of all ranges before:
    no task sees all lines, nor all groups; the one window without a key has a row per
    range."""
    names = [f"_g{i}" for i in range(len(groups))]
    cut = lines.select("*", *[g.alias(n) for g, n in zip(groups, names)])
    sizes = cut.groupBy(*names).agg(F.count(F.lit(1)).alias("_n"))
    # stored, as the ranges are cut by a sample: they must not change from use to use
    sizes = stored(sizes.repartitionByRange(*names).withColumn("_range", F.spark_partition_id()),
                   "line-groups")
    before = (Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("_range").agg(F.sum("_n").alias("_n"))
    ranges = ranges.select("_range", F.coalesce(F.sum("_n").over(
        Window.orderBy("_range").rowsBetween(*before)), F.lit(0)).alias("_first"))
    within = F.coalesce(F.sum("_n").over(
        Window.partitionBy("_range").orderBy(*names).rowsBetween(*before)), F.lit(0))
    offsets = (sizes.withColumn("_w", within).join(ranges, "_range")
               .select(*names, (F.col("_first") + F.col("_w")).alias("_off")))
    inside = F.row_number().over(Window.partitionBy(*names).orderBy(*order))
    return (cut.withColumn("_i", inside).join(offsets, names)
            .withColumn(name, F.col("_off") + F.col("_i")).drop(*names, "_i", "_off"))
