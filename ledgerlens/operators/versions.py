"""Difference of two versions of a result: only key buckets that differ are read.

A version is written in ``buckets`` folders by a hash of its key, with a small table
of digests: per bucket, the number of rows and two order-free sums of row hashes.  Equal
rows in any order, in any number of files, give equal digests.  Two versions are compared
digest by digest first; the buckets that differ are then read, and only they, and joined in
full on the key: keys of one side only are reported as added or lost, and keys with other
values as changed.  (A bucket whose rows differ is missed only if both 64-bit sums collide.)

The join runs on the key within the buckets read, null keys meet, and a key that stands more
than once is compared as a multiset of its rows.
"""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 64
DIGEST = ("rows", "sum_a", "sum_b")


def _canonical(df: DataFrame, columns):
    # -0.0 and 0.0 are equal and must hash alike; nulls count by their place
    parts = []
    for c in columns:
        kind = df.schema[c].dataType.typeName()
        col = F.col(c) + F.lit(0.0) if kind in ("double", "float") else F.col(c)
        parts += [F.col(c).isNull(), col]
    return parts


def digests(df: DataFrame, columns) -> DataFrame:
    """(bucket, rows, sum_a, sum_b) of a frame with a ``bucket`` column."""
    parts = _canonical(df, columns)
    exact = "decimal(20,0)"                     # sums of 64-bit hashes, without overflow
    return df.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64(*parts).cast(exact)).cast("string").alias("sum_a"),
        F.sum(F.xxhash64(F.lit("b"), *parts).cast(exact)).cast("string").alias("sum_b"))


def write_version(df: DataFrame, path: str, keys, buckets: int = BUCKETS) -> str:
    """Write a version: data by bucket, digests of what was written beside it."""
    columns = df.columns
    bucket = F.pmod(F.xxhash64(*_canonical(df, keys)), F.lit(buckets)).cast("int")
    data = posixpath.join(path, "data")
    (df.withColumn("bucket", bucket).repartition("bucket")
     .write.mode("overwrite").partitionBy("bucket").parquet(data))
    written = _data(df.sparkSession, path, df.schema)
    digests(written, columns).coalesce(1).write.mode("overwrite").parquet(
        posixpath.join(path, "digests"))
    return path


def _data(spark: SparkSession, path: str, schema) -> DataFrame:
    from pyspark.sql import types as T
    full = T.StructType([*schema.fields, T.StructField("bucket", T.IntegerType())])
    return spark.read.schema(full).parquet(posixpath.join(path, "data"))


def differing_buckets(spark: SparkSession, old: str, new: str) -> list[int]:
    """Buckets whose digests differ, or that one version lacks (the number of buckets
    bounds what comes to the driver)."""
    a, b = (spark.read.parquet(posixpath.join(p, "digests")) for p in (old, new))
    a = a.select("bucket", F.struct(*DIGEST).alias("a"))
    b = b.select("bucket", F.struct(*DIGEST).alias("b"))
    return sorted(r["bucket"] for r in a.join(b, "bucket", "full")
                  .filter(~F.col("a").eqNullSafe(F.col("b"))).select("bucket").collect())


def _grouped(df: DataFrame, keys, values, name: str) -> DataFrame:
    rows = F.array_sort(F.collect_list(F.struct(*values)))      # the rows of one key
    return df.groupBy(F.struct(*keys).alias("key")).agg(rows.alias(name))


def difference(spark: SparkSession, old: str, new: str, schema, keys) -> DataFrame:
    """(keys..., status, then old_<column> and new_<column>): keys ``added``, ``lost`` or
    ``changed`` between two written versions; of a repeated key, its first row that differs."""
    keys = list(keys)
    values = [f.name for f in schema.fields if f.name not in keys]
    which = differing_buckets(spark, old, new)
    sides = []
    for path, name in ((old, "old"), (new, "new")):
        part = _data(spark, path, schema).filter(F.col("bucket").isin(which) if which else F.lit(False))
        sides.append(_grouped(part, keys, values, name))
    joined = sides[0].join(sides[1], "key", "full").filter(~F.col("old").eqNullSafe(F.col("new")))
    status = (F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "lost")
              .otherwise("changed"))
    only = {"old": F.array_except("old", F.coalesce("new", F.array().cast(sides[1].schema["new"].dataType))),
            "new": F.array_except("new", F.coalesce("old", F.array().cast(sides[0].schema["old"].dataType)))}
    return joined.select(
        *[F.col(f"key.`{k}`").alias(k) for k in keys], status.alias("status"),
        *[F.get(F.when(F.size(only[s]) > 0, only[s]).otherwise(F.col(s)), F.lit(0))[v]
          .alias(f"{s}_{v}") for v in values for s in ("old", "new")])


def difference_summary(diff: DataFrame) -> DataFrame:
    """(status, groups)."""
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("groups"))
