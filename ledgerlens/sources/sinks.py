"""Result sinks: single-file CSV / Parquet / JSON outputs and read-back.

A single output file means one writing task, so these sinks are for
aggregated results only (one row per group, city, state ...); order-level
frames are written with their natural partitioning instead
(``write_partitioned``).  ``mode('overwrite')`` replaces an existing output.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import scratch_path

def _one_file(df: DataFrame, sort_by=None) -> DataFrame:
    # Sorted after the rows have met in one partition, so the file's order does not
    # depend on the order in which partitions are merged.
    one = df.repartition(1)
    return one.sortWithinPartitions(*sort_by) if sort_by else one


def write_single_csv(df: DataFrame, path: str, sort_by=None, header: bool = True) -> str:
    _one_file(df, sort_by).write.mode("overwrite").option("header", header).csv(path)
    return path


def write_single_parquet(df: DataFrame, path: str, sort_by=None) -> str:
    _one_file(df, sort_by).write.mode("overwrite").parquet(path)
    return path


def write_json(df: DataFrame, path: str, sort_by=None) -> str:
    _one_file(df, sort_by).write.mode("overwrite").json(path)
    return path


def write_partitioned(df: DataFrame, path: str, fmt: str = "parquet",
                      partition_by=None) -> str:
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return path


def read_back(spark: SparkSession, path: str, fmt: str,
              schema: T.StructType | None = None) -> DataFrame:
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        return r.option("header", True).csv(path)
    return r.format(fmt).load(path)


def schema_listing(spark: SparkSession, df: DataFrame) -> DataFrame:
    """(column, dtype) of a frame -- built from the schema, not the data."""
    return spark.createDataFrame(list(df.dtypes), "column string, dtype string")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: it cuts the lineage,
    survives lost executors, and gives Spark the table's real size for its joins."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ---- verified overwrite ----------------------------------------------------------

SUM_DIGITS = 15     # hexadecimal digits of a row's digest that are summed


def row_sums(df: DataFrame) -> list:
    """Aggregates over all rows: their number, and an order-free sum of row digests."""
    text = F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\\N"))
                              for c in df.columns])
    digest = F.conv(F.substring(F.md5(text.cast("binary")), 1, SUM_DIGITS), 16, 10)
    return [F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(digest.cast("decimal(20,0)")), F.lit(0).cast("decimal(30,0)"))
            .cast("string").alias("checksum")]


class SpoiltWrite(RuntimeError):
    """What was read back is not what was written; the old output is in place."""


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the folder ``new`` in the place of ``path``; the old one goes last."""
    fs, make = _filesystem(spark, path)
    aside = None
    if fs.exists(make(path)):
        aside = f"{path}.old-{uuid.uuid4().hex[:12]}"
        if not fs.rename(make(path), make(aside)):
            raise OSError(f"cannot move {path} aside")
    if not fs.rename(make(new), make(path)):
        if aside is not None:
            fs.rename(make(aside), make(path))
        raise OSError(f"cannot put {new} in place")
    if aside is not None:
        fs.delete(make(aside), True)


def write_verified(df: DataFrame, path: str, fmt: str = "parquet", **options) -> dict:
    """Overwrite ``path`` only by what reads back as it was written.

    Rows and checksum are observed while the rows pass into a folder beside ``path``, and
    taken again from what that folder returns under the frame's schema; only if both agree
    does it replace the old output, else it is removed and SpoiltWrite raised.  Returns
    rows_written, checksum_written, rows_read, checksum_read."""
    spark, seen = df.sparkSession, Observation(f"write-{uuid.uuid4().hex}")
    beside = f"{path}.new-{uuid.uuid4().hex[:12]}"
    (df.observe(seen, *row_sums(df)).write.format(fmt).options(**options).save(beside))
    back = spark.read.schema(df.schema).format(fmt).options(**options).load(beside)
    read, written = back.agg(*row_sums(back)).first(), seen.get
    found = {"rows_written": written["rows"], "checksum_written": written["checksum"],
             "rows_read": read["rows"], "checksum_read": read["checksum"]}
    if (found["rows_written"], found["checksum_written"]) != (
            found["rows_read"], found["checksum_read"]):
        fs, make = _filesystem(spark, beside)
        fs.delete(make(beside), True)
        raise SpoiltWrite(f"{path}: {found}")
    replace_folder(spark, beside, path)
    return found


# ---- tables that meet without a shuffle ---------------------------------------------

def write_bucketed(df: DataFrame, name: str, keys, buckets: int, sort_by=None) -> DataFrame:
    """``df`` as a catalog table in ``buckets`` buckets by ``keys``, each sorted, under the
    scratch folder.  Joins and aggregations on the keys read it without an exchange."""
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    # one task per bucket, so that a bucket is one file, and its order holds
    (df.repartition(buckets, *keys).write.format("parquet").bucketBy(buckets, *keys)
     .sortBy(*(sort_by or keys)).option("path", scratch_path(df.sparkSession, name))
     .saveAsTable(table))
    return df.sparkSession.table(table)
