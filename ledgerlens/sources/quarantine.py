"""Sales reports with malformed rows: good rows typed, bad rows kept with reason and place.

The plain readers of ``sources.sales`` turn a damaged field into a null or drop the row.
Here every line is read as text, once: it is split by Spark's CSV parser, each field that must
be typed is tried, and the line goes to one of two folders of the same write,

    outcome=good        the typed sales columns
    outcome=rejected    the line, its reasons, its file, block and place in the block

The counts of both are observed while the rows pass; no second pass over the report.
Lines are records: a quoted line break is not supported.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions.clean import parse_sales_date
from ledgerlens.sources.logs import read_log_text
from ledgerlens.sources.sales import CSV_HEADER_TO_COLUMN

COLUMNS = tuple(c for _, c in CSV_HEADER_TO_COLUMN)
HEADER = ",".join(h for h, _ in CSV_HEADER_TO_COLUMN)
# Reasons, in the order in which they are listed.
REASONS = ("fields", "order_date", "qty", "amount")
CSV_OPTIONS = {"escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}


def _blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def judged(spark: SparkSession, path: str) -> DataFrame:
    """(sales columns typed, raw, file, block, place, reasons array<string>) per line."""
    lines = read_log_text(spark, path).filter((F.col("value") != HEADER) & (F.trim("value") != ""))
    # the record number inside the block: the low bits of Spark's row number
    place = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    schema = ", ".join([*(f"{c} string" for c in COLUMNS), "_corrupt string"])
    rows = lines.select(F.from_csv("value", F.lit(schema), CSV_OPTIONS).alias("r"),
                        F.col("value").alias("raw"), "file", "block", place.alias("place"))
    typed = {"order_date": parse_sales_date(F.col("r.order_date")),
             "qty": F.col("r.qty").try_cast("int"), "amount": F.col("r.amount").try_cast("double")}
    # each field is tried once: the reasons are read from what came of it
    rows = rows.select(*[typed.get(c, F.col(f"r.{c}")).alias(c) for c in COLUMNS],
                       "raw", "file", "block", "place", F.col("r._corrupt").isNotNull().alias("fields"),
                       _blank(F.col("r.amount")).alias("no_amount"))
    # an amount may be missing, a date and a quantity may not; the fields of a line with
    # too few or too many of them are not judged
    missing = {c: ~F.col("fields") & F.col(c).isNull() for c in ("order_date", "qty", "amount")}
    bad = missing | {"fields": F.col("fields"), "amount": missing["amount"] & ~F.col("no_amount")}
    reasons = F.array_remove(F.array(*[F.when(bad[r], F.lit(r)).otherwise("") for r in REASONS]), "")
    return rows.select(*COLUMNS, "raw", "file", "block", "place", reasons.alias("reasons"))


def route(spark: SparkSession, path: str, out: str) -> dict[str, int]:
    """Write both outcomes of the report at ``path`` under ``out``; returns the number of
    lines, of rejected ones, and of those with each reason."""
    rows, seen = judged(spark, path), Observation(f"quarantine-{uuid.uuid4().hex}")
    bad = F.size("reasons") > 0
    counts = [F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("rejected"), *[
        F.count_if(F.array_contains("reasons", r)).alias(r) for r in REASONS]]
    blank = [F.when(~bad, F.col(c)).alias(c) for c in COLUMNS]
    keep = [F.when(bad, F.col(c)).alias(c) for c in ("raw", "file", "block", "place", "reasons")]
    (rows.observe(seen, *counts)
     .select(*blank, *keep, F.when(bad, "rejected").otherwise("good").alias("outcome"))
     .write.partitionBy("outcome").parquet(out))
    return seen.get


def good_rows(spark: SparkSession, out: str) -> DataFrame:
    return _read(spark, out, "good").select(*COLUMNS)


def rejected_rows(spark: SparkSession, out: str) -> DataFrame:
    """(raw, reasons, file, block, place) of the lines that were not taken over."""
    return _read(spark, out, "rejected").select("raw", "reasons", "file", "block", "place")


def _read(spark: SparkSession, out: str, outcome: str) -> DataFrame:
    types = {"order_date": "date", "qty": "int", "amount": "double"}
    schema = ", ".join([*(f"{c} {types.get(c, 'string')}" for c in COLUMNS),
                        "raw string, file string, block long, place long, reasons array<string>",
                        "outcome string"])
    return spark.read.schema(schema).parquet(out).filter(F.col("outcome") == outcome)


def write_damaged_report(sales: DataFrame, path: str) -> str:
    """The sales frame as lines of a report with stated damage, as large as the tables: a
    date that is none (order id divisible by 50) or blank (50, rest 1), a quantity (70) and an
    amount (90) that are no numbers, a line cut after its fifth field (110), and one
    with a field too many (130)."""
    n = F.col("order_id")
    text = {"order_date": F.when(n % 50 == 0, F.lit("not a date")).when(n % 50 == 1, F.lit(""))
            .otherwise(F.date_format("order_date", "MM-dd-yy")),
            "qty": F.when(n % 70 == 0, F.lit("x")).otherwise(F.col("qty").cast("string")),
            "amount": F.when(n % 90 == 0, F.lit("n/a")).otherwise(F.col("amount").cast("string"))}
    columns = [text.get(c, F.col(c).cast("string")).alias(c) for c in COLUMNS]
    options = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    whole = F.to_csv(F.struct(*columns), options)
    cut = F.to_csv(F.struct(*columns[:5]), options)
    (sales.select(F.when(n % 110 == 0, cut).when(n % 130 == 0, F.concat(whole, F.lit(",more")))
                  .otherwise(whole).alias("value")).write.text(path))
    return path
