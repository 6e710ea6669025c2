"""Command-line entry points for the four sales jobs.

    python -m ledgerlens.jobs trailing-mode      INPUT OUTPUT
    python -m ledgerlens.jobs median-variety     INPUT OUTPUT
    python -m ledgerlens.jobs qualification-rate INPUT OUTPUT
    python -m ledgerlens.jobs percentile-stddev  INPUT OUTPUT

INPUT is the sales-report CSV, or a folder of the star-schema Parquet tables
(``--tables``).  OUTPUT is a folder that is replaced if it exists.  Small
per-state / per-city reports are written as one file (key-ordered); the
per-group percentile table, which grows with the data, is written with its
natural partitioning.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import percentiles, promotions, trailing, variety
from ledgerlens.session import SESSION_DEFAULTS
from ledgerlens.sources import sinks
from ledgerlens.sources.sales import sales_from_csv, sales_from_tables

# Output column names of the job reports.
VARIETY_HEADER = ("Month", "State", "MedianVariety")
QUALIFICATION_COLUMNS = ("City", "Percentage_Qualified_Cancelled_Standard")
PERCENTILE_KEY_COLUMNS = ("SKU", "Month")


def _sales(spark: SparkSession, path: str, tables: bool, cols) -> DataFrame:
    return sales_from_tables(spark, path, cols) if tables else sales_from_csv(spark, path)


def run_trailing_mode(spark, inp, out, tables=False):
    sales = _sales(spark, inp, tables, ("order_date", "status", "size", "qty", "state"))
    report = trailing.as_report(trailing.size_mode_by_state(sales))
    return sinks.write_single_csv(report, out, sort_by=["State", "TargetDate"])


def run_median_variety(spark, inp, out, tables=False):
    sales = _sales(spark, inp, tables, ("order_date", "state", "style", "sku", "size"))
    m, s, v = VARIETY_HEADER
    res = variety.median_variety(sales).select(
        F.col("month").alias(m), F.col("state").alias(s), F.col("median_variety").alias(v))
    return sinks.write_single_csv(res, out, sort_by=[m, s])


def run_qualification_rate(spark, inp, out, tables=False):
    sales = _sales(spark, inp, tables,
                   ("order_id", "order_date", "status", "fulfilment", "courier_status",
                    "service_level", "amount", "state", "city", "promotion_ids"))
    c, p = QUALIFICATION_COLUMNS
    res = promotions.qualification_rate(sales).select(
        F.col("city").alias(c), F.col("pct_qualified").alias(p))
    return sinks.write_single_parquet(res, out, sort_by=[c])


def run_percentile_stddev(spark, inp, out, tables=False):
    sales = _sales(spark, inp, tables, ("order_id", "order_date", "sku", "amount", "promotion_ids"))
    wide = percentiles.percentile_stddev(percentiles.promo_orders(sales))
    k1, k2 = PERCENTILE_KEY_COLUMNS
    wide = wide.withColumnRenamed("sku", k1).withColumnRenamed("month", k2)
    return sinks.write_partitioned(wide, out)


JOBS = {
    "trailing-mode": run_trailing_mode,
    "median-variety": run_median_variety,
    "qualification-rate": run_qualification_rate,
    "percentile-stddev": run_percentile_stddev,
}


def main(argv=None, spark: SparkSession | None = None) -> str:
    ap = argparse.ArgumentParser(prog="ledgerlens.jobs")
    ap.add_argument("job", choices=sorted(JOBS))
    ap.add_argument("input")
    ap.add_argument("output")
    ap.add_argument("--tables", action="store_true",
                    help="INPUT is a folder of the star-schema Parquet tables")
    a = ap.parse_args(argv)
    if spark is None:
        builder = SparkSession.builder.appName(f"ledgerlens-{a.job}")
        for key, value in SESSION_DEFAULTS.items():
            builder = builder.config(key, value)
        spark = builder.getOrCreate()
    return JOBS[a.job](spark, a.input, a.output, a.tables)


if __name__ == "__main__":
    print(main(sys.argv[1:]))
