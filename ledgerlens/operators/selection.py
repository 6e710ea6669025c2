"""Exact percentiles of a value with many levels, by repeated bucket counting.

``percentiles.threshold_exact`` walks a group's distinct values in one task, which is right
for promotion counts and wrong for amounts.  Here the rank is closed in on instead, for all
groups at once:

1. Lines are reduced to (group, value, count) with map-side combine and dealt by both, so
   a group holding a third of all lines is spread over the cluster.
2. A bracket is an open interval of a group's values that holds a wanted rank.  While it
   has more than ``small`` distinct values, a sketch names ``buckets - 1`` of them as cuts;
   the lines below, at and between the cuts are counted exactly, and the bucket with the
   rank becomes the next bracket -- or the answer, if it is a single value, as every cut is.
3. A bracket of ``small`` distinct values at most is walked in one task.

The cuts share out distinct values, however they are distributed and whatever a single
value weighs, so each round leaves about one part in ``buckets`` of a bracket: five rounds
for 10 ** 11 distinct values.  A round only reads the rows of the brackets that are left.  The
cuts only decide how fast the loop ends; the counts decide the result.

Every join of rows with brackets is stored before it is grouped.  So a lost executor costs one
step at most, Spark knows the brackets' size when it picks the join, aggregations combine
map-side, and where the brackets are too many to broadcast, the partitions of a hot group can
be split: no grouping on the same key holds them together.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.percentiles import LEVELS, nearest_rank
from ledgerlens.sources.sinks import stored

SMALL = 4096        # distinct values walked in one task
BUCKETS = 32
ACCURACY = 1000     # of the sketch that names the cuts


def _key(keys):
    # one struct: groups with a null key are groups like any other, in joins too
    return F.struct(*keys) if keys else F.struct(F.lit(0).alias("_all"))


def _walk(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(_key, level, value): the wanted ranks of brackets with few distinct values."""
    w = Window.partitionBy("_key", "path").orderBy("value")
    upto = rows.withColumn("upto", F.sum("n").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    return (upto.join(wanted.select("_key", "path", "level", "want"), ["_key", "path"])
            .filter((F.col("upto") - F.col("n") < F.col("want"))
                    & (F.col("want") <= F.col("upto")))
            .select("_key", "level", "value"))


def _narrow(rows: DataFrame, wanted: DataFrame, buckets: int) -> tuple[DataFrame, DataFrame]:
    """One round over brackets with many distinct values: (rows with their bucket,
    (_key, path, level, want, distinct, low, high, bucket) of the buckets that hold a rank)."""
    shares = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    cuts = stored(rows.groupBy("_key", "path").agg(
        F.array_distinct(F.percentile_approx("value", shares, ACCURACY)).alias("cuts")), "cuts")
    # places in order: below cut 0, cut 0, between cuts 0 and 1, cut 1, ...
    below = reduce(add, [F.coalesce(F.col("value") > F.get("cuts", F.lit(i)), F.lit(False))
                         .cast("int") for i in range(buckets - 1)])
    dealt = stored(rows.join(cuts, ["_key", "path"])
                   .select("_key", "path", "value", "n",
                           (2 * below + F.array_contains("cuts", F.col("value")).cast("int"))
                           .alias("bucket")), "dealt")
    counts = dealt.groupBy("_key", "path", "bucket").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("distinct"),
        F.min("value").alias("low"), F.max("value").alias("high"))
    # a window over 2 * buckets rows of a bracket
    w = Window.partitionBy("_key", "path").orderBy("bucket")
    counts = counts.withColumn("upto", F.sum("n").over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    before = F.col("upto") - F.col("n")
    hit = (wanted.select("_key", "path", "level", "want").join(counts, ["_key", "path"])
           .filter((before < F.col("want")) & (F.col("want") <= F.col("upto")))
           .select("_key", "path", "level", (F.col("want") - before).alias("want"),
                   "distinct", "low", "high", "bucket"))
    return dealt, hit


def select_percentiles(df: DataFrame, keys=(), value="amount", levels=LEVELS,
                       small: int = SMALL, buckets: int = BUCKETS) -> DataFrame:
    """(keys..., n, a column per level): nearest-rank percentiles of ``value`` per group,
    nulls left out; groups without a value have no row."""
    keys = list(keys)
    rows = stored(df.filter(F.col(value).isNotNull())
                  .select(_key(keys).alias("_key"), F.col(value).alias("value"))
                  .groupBy("_key", "value").agg(F.count(F.lit(1)).alias("n"))
                  .withColumn("path", F.lit("")), "frequencies")
    sizes = stored(rows.groupBy("_key").agg(F.sum("n").alias("total"),
                                            F.count(F.lit(1)).alias("distinct")), "group-sizes")
    wanted = sizes.select("_key", F.lit("").alias("path"), "distinct", F.explode(F.array(*[
        F.struct(F.lit(name).alias("level"), nearest_rank(F.col("total"), p).cast("long")
                 .alias("want")) for name, p in levels])).alias("w")).select(
        "_key", "path", "distinct", "w.level", "w.want")
    found = []
    while True:
        wide = stored(wanted.filter(F.col("distinct") > small).select("_key", "path").distinct(),
                      "wide-brackets")
        if wide.isEmpty():
            found.append(_walk(rows, wanted))
            break
        few = stored(rows.join(wide, ["_key", "path"], "left_anti"), "small-brackets")
        found.append(_walk(few, wanted.filter(F.col("distinct") <= small)))
        rows = stored(rows.join(wide, ["_key", "path"], "left_semi"), "wide-rows")
        dealt, hit = _narrow(rows, wanted.filter(F.col("distinct") > small), buckets)
        hit = stored(hit, "buckets-with-ranks")
        single = F.col("low") == F.col("high")
        found.append(hit.filter(single).select("_key", "level", F.col("low").alias("value")))
        inner = F.concat("path", F.col("bucket").cast("string"), F.lit("."))
        wanted = hit.filter(~single).select("_key", inner.alias("path"), "distinct", "level", "want")
        rows = stored(dealt.join(hit.filter(~single).select("_key", "path", "bucket").distinct(),
                                 ["_key", "path", "bucket"], "left_semi")
                      .select("_key", inner.alias("path"), "value", "n"), "brackets")
    values = reduce(DataFrame.unionByName, found)
    out = values.groupBy("_key").agg(*[
        F.max(F.when(F.col("level") == name, F.col("value"))).alias(name) for name, _ in levels])
    return out.join(sizes, "_key").select(
        *[F.col(f"_key.`{k}`").alias(k) for k in keys], F.col("total").alias("n"),
        *[name for name, _ in levels])


def select_percentile_stddev(df: DataFrame, keys=(), value="amount", measure="amount",
                             levels=LEVELS, small: int = SMALL, buckets: int = BUCKETS
                             ) -> DataFrame:
    """(keys..., n, then threshold_<level>, orders_<level>, stddev_<level>): as
    ``percentiles.percentile_stddev`` by the exact method, for a value with many levels.

    The lines meet the thresholds, one row per group, and are combined map-side."""
    keys, names = list(keys), [name for name, _ in levels]
    found = select_percentiles(df, keys, value, levels, small, buckets)
    found = stored(found.select(_key(keys).alias("_key"), "n", *names), "thresholds")
    lines = df.filter(F.col(value).isNotNull()).select(
        _key(keys).alias("_key"), F.col(value).alias("_value"), F.col(measure).alias("_measure"))
    joined = lines.join(found, "_key")
    aggs = []
    for name in names:
        over = F.col("_value") >= F.col(name)
        of = F.when(over, F.col("_measure"))
        aggs += [F.max(name).alias(f"threshold_{name}"), F.count_if(over).alias(f"orders_{name}"),
                 # equal amounts: exactly 0
                 F.when((F.count_if(over) < 2) | (F.min(of) == F.max(of)), F.lit(0.0))
                 .otherwise(F.coalesce(F.stddev_pop(of), F.lit(0.0))).alias(f"stddev_{name}")]
    out = joined.groupBy("_key").agg(F.max("n").alias("n"), *aggs)
    return out.select(*[F.col(f"_key.`{k}`").alias(k) for k in keys],
                      *[c for c in out.columns if c != "_key"])
