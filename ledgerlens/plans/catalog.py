"""Registry of the named queries: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver's tables at ``sf_dir`` (only the columns it
needs) and runs one operator over the whole input.  Double results that come
from sums of many doubles (averages, standard deviations) are rounded to
``FLOAT_DIGITS`` places here, at the very end, so that two engines summing in
different orders produce identical values; the operators themselves return
full precision.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.clean import int_or_zero, norm_state, parse_sales_date
from ledgerlens.operators import (
    colocated,
    compare,
    heavy_hitters,
    percentiles,
    promotion_state,
    promotions,
    quality,
    runs,
    selection,
    sketches,
    trailing,
    trailing_changes,
    variety,
    versions,
)
from ledgerlens.session import scratch_path
from ledgerlens.sources import logs, quarantine, sinks
from ledgerlens.sources import sales as sales_csv
from ledgerlens.sources.sales import SALES_COLUMNS, sales_from_tables
from ledgerlens.sources.tables import read_table
from ledgerlens.streaming.trailing import run_available_now, trailing_mode_stream

Query = Callable[[SparkSession, str], DataFrame]
FLOAT_DIGITS = 4


def _sales(spark, d, *cols):
    return sales_from_tables(spark, d, cols or SALES_COLUMNS)


def round_cols(df: DataFrame, *cols: str, digits: int = FLOAT_DIGITS) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in cols else F.col(c)
                       for c in df.columns])


# ---- sales frame -------------------------------------------------------------

def q_clean_sales(spark, d):
    return _sales(spark, d)


# ---- trailing-window mode -------------------------------------------------------

_Q1_COLS = ("order_date", "status", "size", "qty", "state")


def q_trailing_mode(spark, d):
    return trailing.size_mode_by_state(_sales(spark, d, *_Q1_COLS))


def q_trailing_mode_window_fn(spark, d):
    return trailing.size_mode_by_state_window_fn(_sales(spark, d, *_Q1_COLS))


def q_trailing_mode_by_changes(spark, d):
    return trailing_changes.size_mode_by_changes(_sales(spark, d, *_Q1_COLS), 7)


def q_trailing_mode_180(spark, d):
    return trailing_changes.size_mode_by_changes(_sales(spark, d, *_Q1_COLS), 180)


def q_trailing_changes_180(spark, d):
    return trailing_changes.size_mode_change_points(_sales(spark, d, *_Q1_COLS), 180)


def q_trailing_mode_streamed(spark, d):
    """The report as a stream over files that come in any order: the watermark spans all
    days, and a closing line far behind the last one lets every window end."""
    lines = trailing.shipped_lines(_sales(spark, d, *_Q1_COLS))
    files, out = scratch_path(spark, "stream-lines"), scratch_path(spark, "stream-modes")
    lines.write.parquet(files)
    r = (spark.read.schema(lines.schema).parquet(files)
         .agg(F.min("day").alias("first"), F.max("day").alias("last")).first())
    schema = "state string, target_date date, top_size string, size_count bigint"
    if r["first"] is None:
        return spark.createDataFrame([], schema)
    span = (r["last"] - r["first"]).days + 8
    closing = spark.range(1).select(
        F.lit("").alias("state"), F.date_add(F.lit(r["last"]), 2 * span).alias("day"),
        F.lit("").alias("size"))
    closing.write.mode("append").parquet(files)
    stream = spark.readStream.schema(lines.schema).parquet(files)
    run_available_now(trailing_mode_stream(stream, watermark=f"{span} days"), out,
                      scratch_path(spark, "stream-checkpoint"))
    return spark.read.schema(schema).parquet(out)


# ---- median variety -----------------------------------------------------------

_Q2_COLS = ("order_date", "state", "style", "sku", "size")


def q_style_variety(spark, d):
    return variety.style_variety(_sales(spark, d, *_Q2_COLS))


def q_median_variety(spark, d):
    return variety.median_variety(_sales(spark, d, *_Q2_COLS))


# ---- qualification rate -------------------------------------------------------

_Q3_COLS = ("order_id", "order_date", "status", "fulfilment", "courier_status",
            "service_level", "amount", "state", "city", "promotion_ids")


def q_valid_promotions(spark, d):
    return promotions.valid_promotions(
        _sales(spark, d, "order_id", "order_date", "promotion_ids"))


def q_orders_3_valid_promos(spark, d):
    return promotions.orders_with_valid_promos(
        _sales(spark, d, "order_id", "order_date", "promotion_ids"))


def q_state_avg_amount(spark, d):
    df = promotions.state_avg_amount(
        _sales(spark, d, "fulfilment", "courier_status", "amount", "state"))
    return round_cols(df, "avg_amount")


def q_cancelled_standard_base(spark, d):
    return promotions.base_counts(
        _sales(spark, d, "order_id", "status", "service_level", "amount",
               "state", "city"))


def q_qualification_rate(spark, d):
    return promotions.qualification_rate(_sales(spark, d, *_Q3_COLS))


# ---- dynamic percentile stddev --------------------------------------------------

_Q4_COLS = ("order_id", "order_date", "sku", "amount", "promotion_ids")


def _orders(spark, d):
    return percentiles.promo_orders(_sales(spark, d, *_Q4_COLS))


def _wide(spark, d):
    return percentiles.percentile_stddev(_orders(spark, d))


def _round_wide(df):
    return round_cols(df, *[c for c in df.columns if c.startswith("stddev_")])


def q_promo_count(spark, d):
    return _orders(spark, d)


def q_promo_cdf(spark, d):
    return percentiles.promo_cdf(_orders(spark, d))


def q_threshold_exact(spark, d):
    return percentiles.threshold_exact(_orders(spark, d))


def q_threshold_disc(spark, d):
    return percentiles.threshold_disc(_orders(spark, d))


def q_threshold_approx(spark, d):
    return percentiles.threshold_approx(_orders(spark, d))


def q_percentile_stddev(spark, d):
    return _round_wide(_wide(spark, d))


def _by_month_and_overall(spark, d):
    """Lines once under their month of the year and once under a null month, for all."""
    every = F.explode(F.array(F.col("month"), F.lit(None).cast("int")))
    return _orders(spark, d).select(every.alias("month"), "amount")


def q_amount_percentiles(spark, d):
    return selection.select_percentiles(_by_month_and_overall(spark, d), ("month",))


def q_amount_percentile_stddev(spark, d):
    return _round_wide(selection.select_percentile_stddev(
        _by_month_and_overall(spark, d), ("month",)))


# ---- stored sketches -------------------------------------------------------------

def _merged_sketches(spark, d, keys, value):
    """Sketches per (SKU, month, day), kept as a table, merged to ``keys``."""
    sales = _sales(spark, d, *_Q4_COLS)
    fine = (percentiles.promo_orders(sales.withColumn("order_id", F.dayofmonth("order_date")))
            .withColumnRenamed("order_id", "day"))
    table = sinks.stored(sketches.quantile_sketches(fine, ["sku", "month", "day"], value),
                         "day-sketches")
    kind = "double" if value == "amount" else "bigint"
    return sketches.sketch_quantiles(sketches.merge_sketches(table, keys, kind), keys, kind)


def q_sketch_thresholds(spark, d):
    return (_merged_sketches(spark, d, ["sku", "month"], "promo_count")
            .select("sku", "month", F.col("p80").cast("int").alias("p80"),
                    F.col("p90").cast("int").alias("p90")))


def q_sketch_rank_error(spark, d):
    """The report without what differs from run to run: the estimate and its error."""
    found = sketches.rank_errors(_merged_sketches(spark, d, ["month"], "amount"),
                                 _orders(spark, d), ["month"], "amount")
    return found.drop("estimate", "rank_error")


def q_kept_skus(spark, d):
    """SKUs that a state sells in a month and the one before it in its calendar."""
    sold = _sales(spark, d, "order_date", "state", "sku").select(
        norm_state("state").alias("state"),
        F.date_format("order_date", "yyyy-MM").alias("period"), "sku")
    return sketches.kept_report(sold, ["state"], "period", "sku", lg=6)


# ---- heavy hitters ----------------------------------------------------------------

def q_heavy_sku_customers(spark, d):
    """(SKU, customer) with more than 3 in 100,000 of all lines."""
    lines = read_table(spark, d, "lineitem", ["l_orderkey", "l_partkey"])
    orders = read_table(spark, d, "orders", ["o_orderkey", "o_custkey"])
    return heavy_hitters.heavy_keys(
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(F.col("l_partkey").alias("sku"), F.col("o_custkey").alias("customer")),
        ["sku", "customer"], 0.00003)


def q_heavy_sizes(spark, d):
    """(State, size) with more than 4 in 1,000 of all lines."""
    return heavy_hitters.heavy_keys(_sales(spark, d, "state", "size"), ["state", "size"], 0.004)


# ---- promotion state, kept up by increments --------------------------------------------

INCREMENTS = 4


def _replayed(spark, d):
    """The state after the calendar, cut into equal spans of days, one after the other."""
    lines = _sales(spark, d, "order_id", "order_date", "promotion_ids")
    r = lines.agg(F.min("order_date").alias("first"), F.max("order_date").alias("last")).first()
    if r["first"] is None:
        return promotion_state.replay([lines])
    span = (r["last"] - r["first"]).days // INCREMENTS + 1
    part = F.floor(F.datediff("order_date", F.lit(r["first"])) / span)
    return promotion_state.replay(lines.filter(part == i) for i in range(INCREMENTS))


def q_orders_by_increments(spark, d):
    return promotion_state.qualifying_orders(_replayed(spark, d))


def q_promotions_by_increments(spark, d):
    return promotion_state.valid_promotions(_replayed(spark, d))


# ---- tables that meet without a shuffle --------------------------------------------------

def q_qualification_rate_colocated(spark, d):
    return colocated.qualification_rate(colocated.lines_by_order(_sales(spark, d, *_Q3_COLS)))


def q_percentile_stddev_colocated(spark, d):
    return _round_wide(colocated.percentile_stddev(
        colocated.lines_by_group(_sales(spark, d, *_Q4_COLS))))


# ---- difference of two versions -------------------------------------------------------

def _versions(spark, d):
    """(paths of two versions of the exact thresholds, their schema): the second has p80 up by
    one for some SKUs, lacks the first months of others, and has month 13 instead of a
    copy of month 5 for others more."""
    old = percentiles.threshold_exact(_orders(spark, d))
    sku = F.col("sku").cast("bigint") % 997
    new = old.filter(~((sku == 42) & (F.col("month") <= 2))).select(
        "sku", "month", (F.col("p80") + F.when(sku == 7, 1).otherwise(0)).alias("p80"), "p90")
    new = new.unionByName(old.filter((sku == 99) & (F.col("month") == 5))
                          .withColumn("month", F.lit(13)))
    paths = [versions.write_version(df, scratch_path(spark, "thresholds"), ["sku", "month"])
             for df in (old, new)]
    return (*paths, old.schema)


def q_version_diff(spark, d):
    old, new, schema = _versions(spark, d)
    return versions.difference(spark, old, new, schema, ["sku", "month"])


def q_version_diff_summary(spark, d):
    return versions.difference_summary(q_version_diff(spark, d))


# ---- comparison reports ------------------------------------------------------

# On these tables the sketch is exact, so that every comparison would be empty.  The
# reports therefore compare against thresholds that are off by one in stated groups
# (p80 up where the SKU is a multiple of 7, p90 down where it is one of 5); the oracle
# states the same shift in SQL.

def _drifted(o):
    sku = F.col("sku").cast("bigint")
    thr = percentiles.threshold_approx(o)
    return thr.select("sku", "month",
                      (F.col("p80") + F.when(sku % 7 == 0, 1).otherwise(0)).alias("p80"),
                      (F.col("p90") - F.when(sku % 5 == 0, 1).otherwise(0)).alias("p90"))


def _wide_drifted(spark, d):
    o = _orders(spark, d)
    return percentiles.percentile_stddev(o, approx=_drifted(o))


def q_threshold_diff(spark, d):
    o = _orders(spark, d)
    return compare.threshold_diff(_drifted(o), percentiles.threshold_exact(o))


def q_threshold_mismatch_top(spark, d):
    return compare.top_threshold_mismatches(q_threshold_diff(spark, d), "p80", 20)


def q_threshold_mismatch_top_p90(spark, d):
    return compare.top_threshold_mismatches(q_threshold_diff(spark, d), "p90", 20)


def q_threshold_accuracy(spark, d):
    return round_cols(compare.threshold_accuracy(_wide_drifted(spark, d)),
                      "mismatch_rate_percent", "mean_abs_threshold_diff")


def q_mismatch_union(spark, d):
    return compare.mismatch_union(_wide_drifted(spark, d))


def q_mismatch_union_top(spark, d):
    return compare.mismatch_union(_wide_drifted(spark, d), k=20)


def q_result_drift(spark, d):
    df = compare.result_drift(_wide_drifted(spark, d))
    return round_cols(df, "stddev_approx", "stddev_exact")


def q_diff_groups(spark, d):
    df = compare.diff_groups(_wide_drifted(spark, d))
    return round_cols(df, "stddev_approx", "stddev_exact", "stddev_diff")


def q_qualifying_diff_summary(spark, d):
    return round_cols(compare.qualifying_diff_summary(_wide_drifted(spark, d)),
                      "mean_abs_qualifying_count_diff", "mean_abs_stddev_diff",
                      "max_abs_stddev_diff")


# ---- validation and profile reports ------------------------------------------------

def q_heavy_groups(spark, d):
    return quality.heavy_groups(_orders(spark, d), ("sku", "month"), 5)


def q_heavy_months(spark, d):
    return quality.heavy_groups(_orders(spark, d), ("month",), 1000)


def q_top_groups(spark, d):
    return quality.top_groups(_orders(spark, d), ("sku", "month"), 10)


def q_largest_groups(spark, d):
    wide = percentiles.percentile_stddev(_orders(spark, d), methods=("exact",))
    df = quality.largest_groups(wide, 10)
    return round_cols(df, "stddev_p80_exact", "stddev_p90_exact")


def q_validate_result(spark, d):
    return quality.validate_result(_wide(spark, d))


def q_validate_damaged(spark, d):
    """The checks on a result with stated damage: other thresholds, counts above the total,
    stddevs without lines, repeated groups, a missing column."""
    sku = F.col("sku").cast("bigint")
    wide = _wide_drifted(spark, d)
    wide = wide.withColumns({
        "orders_p90_exact": F.when(sku % 11 == 0, F.col("total_orders") + 1)
                             .otherwise(F.col("orders_p90_exact")),
        "stddev_p90_approx": F.when(F.col("orders_p90_approx") < 2, 1.0)
                              .otherwise(F.col("stddev_p90_approx"))}).drop("stddev_p80_exact")
    return quality.validate_result(wide.unionByName(wide.filter(sku % 97 == 0)))


def q_zero_breakdown(spark, d):
    return quality.zero_breakdown(_wide(spark, d))


def q_overview(spark, d):
    return round_cols(quality.overview(quality.group_counts(_orders(spark, d))),
                      "mean_orders_per_group")


def q_histogram(spark, d):
    return round_cols(quality.histogram(quality.group_counts(_orders(spark, d)),
                                        "total_orders", 50), "bin_lower", "bin_upper")


def _stddev_histogram(spark, d, column):
    wide = percentiles.percentile_stddev(_orders(spark, d), methods=("exact",))
    return round_cols(quality.histogram(round_cols(wide.select(column), column), column, 50),
                      "bin_lower", "bin_upper")


def q_histogram_stddev_p80(spark, d):
    return _stddev_histogram(spark, d, "stddev_p80_exact")


def q_histogram_stddev_p90(spark, d):
    return _stddev_histogram(spark, d, "stddev_p90_exact")


def q_profile_summary(spark, d):
    # only the profiled columns: no join for the others
    sales = _sales(spark, d, "amount", "sku", "promotion_ids", "order_date")
    return quality.profile_summary(sales).withColumn("num_columns", F.lit(len(SALES_COLUMNS)))


def q_column_profile(spark, d):
    return quality.column_profile(_sales(spark, d))


# ---- the report as CSV text ------------------------------------------------------

def _sales_csv(spark, d):
    """A sales CSV with damaged rows, as large as the tables, in the shared folder."""
    return sales_csv.write_sales_csv(_sales(spark, d), scratch_path(spark, "sales-csv"))


def q_csv_by_name(spark, d):
    return sales_csv.sales_from_csv(spark, _sales_csv(spark, d))


def q_csv_by_position(spark, d):
    raw = sales_csv.read_sales_csv_positional(spark, _sales_csv(spark, d), 12)
    at = {c: f"_c{i}" for i, (_, c) in enumerate(sales_csv.CSV_HEADER_TO_COLUMN)}
    day = parse_sales_date(at["order_date"])
    return (raw.filter(day.isNotNull() & (int_or_zero(at["qty"]) > 0))
            .groupBy(norm_state(at["state"]).alias("state"), day.alias("day"))
            .agg(F.count(F.lit(1)).alias("lines"), F.sum(int_or_zero(at["qty"])).alias("qty")))


def q_profile_raw(spark, d):
    raw = sales_csv.read_sales_csv_raw(spark, _sales_csv(spark, d))
    names = {c: h for h, c in sales_csv.CSV_HEADER_TO_COLUMN}
    return quality.profile_raw(raw, {c: names[c] for c in (
        "amount", "sku", "order_date", "qty", "promotion_ids")})


def _quarantined(spark, d):
    report = quarantine.write_damaged_report(_sales(spark, d), scratch_path(spark, "damaged-report"))
    out = scratch_path(spark, "quarantine")
    return out, quarantine.route(spark, report, out)


def q_quarantine_rows(spark, d):
    """The rejected lines with their reasons, and whether their place is known."""
    out, _ = _quarantined(spark, d)
    place = F.col("file").isNotNull() & (F.col("block") >= 0) & (F.col("place") >= 0)
    return quarantine.rejected_rows(spark, out).select(
        F.split("raw", ",")[0].cast("bigint").alias("order_id"),
        F.concat_ws(",", "reasons").alias("reasons"), place.alias("has_place"))


def q_quarantine_counts(spark, d):
    """The counts observed in the pass, beside those of the two outcomes as read back."""
    out, seen = _quarantined(spark, d)
    back = quarantine.rejected_rows(spark, out).select(F.explode("reasons").alias("outcome"))
    good = quarantine.good_rows(spark, out).select(F.lit("good").alias("outcome"))
    found = back.unionByName(good).groupBy("outcome").agg(F.count(F.lit(1)).alias("rows"))
    counts = [*((r, seen[r]) for r in quarantine.REASONS), ("good", seen["lines"] - seen["rejected"])]
    observed = spark.createDataFrame(counts, "outcome string, observed bigint")
    return observed.join(found, "outcome", "left").select(
        "outcome", "observed", F.coalesce("rows", F.lit(0)).alias("rows"))


def q_key_integrity(spark, d):
    return sales_csv.key_integrity(spark, d)


def q_promo_distribution(spark, d):
    return quality.promo_distribution(_sales(spark, d, "promotion_ids"))


def q_date_format_classes(spark, d):
    raw = sales_csv.read_sales_csv_raw(spark, _sales_csv(spark, d))
    return quality.date_format_classes(raw, "Date")


def q_sample_rows(spark, d):
    return quality.sample_rows(
        _sales(spark, d, "order_id", "sku", "order_date", "status", "amount",
               "promotion_ids"))


# ---- run-time reports over the event log ----------------------------------------------

def _event_runs(spark, d):
    ev = read_table(spark, d, "events",
                    ["event_id", "user_id", "event_type", "value", "props"])
    return runs.parse_run_lines(logs.event_run_log(ev))


def q_runtime_from_text(spark, d):
    """The summary from log text: lines written to files, read back, numbered, parsed."""
    ev = read_table(spark, d, "events",
                    ["event_id", "user_id", "event_type", "value", "props"])
    path = scratch_path(spark, "run-log")
    logs.event_run_log(ev).select("value").write.text(path)
    lines = runs.number_lines(logs.read_log_text(spark, path), [F.col("file"), F.col("block")],
                              ["pos"], "line").select("line", "value")
    return runs.runtime_summary(runs.parse_run_lines(lines), "click")


def q_runtime_pivot(spark, d):
    return runs.runtime_pivot(_event_runs(spark, d), logs.TIMED_EVENT_TYPES)


def q_runtime_summary(spark, d):
    return runs.runtime_summary(_event_runs(spark, d), "click")


def q_run_numbers(spark, d):
    ev = read_table(spark, d, "events", ["event_id", "value"])
    numbered = runs.number_lines(logs.event_runtime_lines(ev),
                                 [F.floor(F.col("event_id") / 100_000)], ["event_id"], "run")
    return numbered.select("run", F.col("value").cast("double").alias("runtime_seconds"))


def q_run_stats(spark, d):
    r = _event_runs(spark, d).select("method", (F.col("ms") / 1000).alias("seconds"))
    return runs.run_stats(r)


# ---- sinks with read-back ---------------------------------------------------------------

def q_parquet_roundtrip(spark, d):
    path = scratch_path(spark, "qualification")
    sinks.write_single_parquet(q_qualification_rate(spark, d), path, sort_by=["city"])
    return sinks.read_back(spark, path, "parquet")


def q_verified_write(spark, d):
    """Rows and checksum as written and as read back, of a second write over a first."""
    path = scratch_path(spark, "verified-rate")
    result = sinks.stored(q_qualification_rate(spark, d), "rate")
    sinks.write_verified(result.limit(1), path)
    found = sinks.write_verified(result, path)
    now = sinks.read_back(spark, path, "parquet").agg(*sinks.row_sums(result))
    return now.select(F.lit(found["rows_written"]).cast("bigint").alias("rows_written"),
                      F.lit(found["checksum_written"]).alias("checksum_written"),
                      F.col("rows").alias("rows_read"), F.col("checksum").alias("checksum_read"))


def q_csv_roundtrip(spark, d):
    path = scratch_path(spark, "median-variety")
    sinks.write_single_csv(q_median_variety(spark, d), path, sort_by=["month", "state"])
    return sinks.read_back(spark, path, "csv",
                           "month string, state string, median_variety double")


def q_percentile_stddev_parquet(spark, d):
    # one row per group: at scale that is large, so the output is written
    # with its natural partitioning, not squeezed into one file by one task
    path = scratch_path(spark, "percentile-stddev")
    sinks.write_partitioned(_wide(spark, d), path)      # full doubles in the file
    return _round_wide(sinks.read_back(spark, path, "parquet"))


def q_trailing_mode_csv(spark, d):
    path = scratch_path(spark, "trailing-mode")
    report = trailing.as_report(q_trailing_mode(spark, d))
    # key-ordered single file, as the report is read by people
    sinks.write_single_csv(report, path, sort_by=["State", "TargetDate"])
    return sinks.read_back(spark, path, "csv",
                           "State string, TargetDate string, MostBoughtSize string, Count bigint")


def q_json_roundtrip(spark, d):
    path = scratch_path(spark, "run-stats")
    sinks.write_json(q_run_stats(spark, d), path, sort_by=["method"])
    return sinks.read_back(
        spark, path, "json",
        "method string, number_of_runs bigint, mean_seconds double, "
        "stddev_seconds double, min_seconds double, max_seconds double")


def q_json_run_log(spark, d):
    """The runs themselves, one JSON record each, with the name of the task."""
    path = scratch_path(spark, "run-log-json")
    r = _event_runs(spark, d).select(F.lit("events").alias("task"), "method", "run",
                                     (F.col("ms") / 1000).alias("runtime_seconds"))
    sinks.write_partitioned(r, path, "json")
    return sinks.read_back(spark, path, "json",
                           "task string, method string, run bigint, runtime_seconds double")


QUERIES: dict[str, Query] = {
    "sketch_thresholds": q_sketch_thresholds,
    "sketch_rank_error": q_sketch_rank_error,
    "kept_skus": q_kept_skus,
    "heavy_sku_customers": q_heavy_sku_customers,
    "heavy_sizes": q_heavy_sizes,
    "orders_by_increments": q_orders_by_increments,
    "promotions_by_increments": q_promotions_by_increments,
    "qualification_rate_colocated": q_qualification_rate_colocated,
    "percentile_stddev_colocated": q_percentile_stddev_colocated,
    "version_diff": q_version_diff,
    "version_diff_summary": q_version_diff_summary,
    "quarantine_rows": q_quarantine_rows,
    "quarantine_counts": q_quarantine_counts,
    "verified_write": q_verified_write,
    "amount_percentiles": q_amount_percentiles,
    "amount_percentile_stddev": q_amount_percentile_stddev,
    "trailing_mode_by_changes": q_trailing_mode_by_changes,
    "trailing_mode_180": q_trailing_mode_180,
    "trailing_mode_streamed": q_trailing_mode_streamed,
    "trailing_changes_180": q_trailing_changes_180,
    "threshold_mismatch_top_p90": q_threshold_mismatch_top_p90,
    "mismatch_union_top": q_mismatch_union_top,
    "validate_damaged": q_validate_damaged,
    "histogram_stddev_p80": q_histogram_stddev_p80,
    "histogram_stddev_p90": q_histogram_stddev_p90,
    "csv_by_name": q_csv_by_name,
    "csv_by_position": q_csv_by_position,
    "profile_raw": q_profile_raw,
    "column_profile": q_column_profile,
    "key_integrity": q_key_integrity,
    "runtime_from_text": q_runtime_from_text,
    "json_run_log": q_json_run_log,
    "clean_sales": q_clean_sales,
    "trailing_mode": q_trailing_mode,
    "trailing_mode_window_fn": q_trailing_mode_window_fn,
    "style_variety": q_style_variety,
    "median_variety": q_median_variety,
    "valid_promotions": q_valid_promotions,
    "orders_3_valid_promos": q_orders_3_valid_promos,
    "state_avg_amount": q_state_avg_amount,
    "cancelled_standard_base": q_cancelled_standard_base,
    "qualification_rate": q_qualification_rate,
    "promo_count": q_promo_count,
    "promo_cdf": q_promo_cdf,
    "threshold_exact": q_threshold_exact,
    "threshold_disc": q_threshold_disc,
    "threshold_approx": q_threshold_approx,
    "percentile_stddev": q_percentile_stddev,
    "threshold_diff": q_threshold_diff,
    "threshold_mismatch_top": q_threshold_mismatch_top,
    "threshold_accuracy": q_threshold_accuracy,
    "mismatch_union": q_mismatch_union,
    "result_drift": q_result_drift,
    "qualifying_diff_summary": q_qualifying_diff_summary,
    "heavy_groups": q_heavy_groups,
    "heavy_months": q_heavy_months,
    "top_groups": q_top_groups,
    "validate_result": q_validate_result,
    "zero_breakdown": q_zero_breakdown,
    "overview": q_overview,
    "histogram": q_histogram,
    "profile_summary": q_profile_summary,
    "promo_distribution": q_promo_distribution,
    "date_format_classes": q_date_format_classes,
    "sample_rows": q_sample_rows,
    "runtime_pivot": q_runtime_pivot,
    "runtime_summary": q_runtime_summary,
    "run_stats": q_run_stats,
    "parquet_roundtrip": q_parquet_roundtrip,
    "csv_roundtrip": q_csv_roundtrip,
    "json_roundtrip": q_json_roundtrip,
    "trailing_mode_csv": q_trailing_mode_csv,
    "run_numbers": q_run_numbers,
    "largest_groups": q_largest_groups,
    "diff_groups": q_diff_groups,
    "percentile_stddev_parquet": q_percentile_stddev_parquet,
}
