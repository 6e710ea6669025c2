"""Exact heavy hitters with bounded memory, in two passes.

Which keys hold more than a share of all lines?  ``quality.heavy_groups`` counts every
key, and shuffles as many rows as there are keys.  Here a task keeps ``counters`` of them at
most: when a batch brings it over, all counts are lowered by the largest one that does not
fit, and what falls to nothing is dropped (a mergeable frequent-items summary).  A count is
too low by the lines of all tasks / (counters + 1) at most, so every key above the share is
among the summed counts above share - 1 / (counters + 1); with counters = 2 / share
there are 2 / share such candidates at most, whatever the input.  The second pass counts the
candidates exactly; they are few enough to be broadcast.

Shuffled are ``counters`` rows per task in the first pass, and the candidates' partial
counts in the second.  Null keys are keys like any other.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.sources.sinks import stored


def lowered(counts: pd.Series, counters: int) -> pd.Series:
    """The ``counters`` largest counts, less the largest one that does not fit."""
    if len(counts) <= counters:
        return counts
    counts = counts.sort_values(ascending=False)
    left = counts.iloc[:counters] - counts.iloc[counters]
    return left[left > 0]


def summaries(df: DataFrame, keys, counters: int) -> DataFrame:
    """(key struct, n, seen): each task's counts, and once its number of lines."""
    source = df.select(F.struct(*keys).alias("key"), F.to_json(
        F.struct(*keys), {"ignoreNullFields": "false"}).alias("text"))
    schema = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("seen", T.LongType())])

    def run(batches):
        held, seen = pd.Series(dtype="int64"), 0
        for pdf in batches:
            seen += len(pdf)
            held = held.add(pdf["text"].value_counts(), fill_value=0).astype("int64")
            held = lowered(held, counters)
        yield pd.DataFrame({"text": [None, *held.index], "n": [0, *held], "seen": [seen] + [0] * len(held)})
    return source.select("text").mapInPandas(run, schema)


def heavy_keys(df: DataFrame, keys, share: float) -> DataFrame:
    """(keys..., lines, total_lines): exactly the keys with more than ``share`` of all lines."""
    keys = list(keys)
    counters = math.ceil(2 / share)
    text = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"})
    found = stored(summaries(df, keys, counters).groupBy("text")
                   .agg(F.sum("n").alias("n"), F.sum("seen").alias("seen")), "summaries")
    total = found.agg(F.sum("seen").alias("lines")).first()["lines"] or 0
    least = share * total - total / (counters + 1)
    # 2 / share rows at most
    candidates = found.filter(F.col("text").isNotNull() & (F.col("n") > F.lit(least))).select("text")
    lines = df.select(*keys, text.alias("text"))
    return (lines.join(F.broadcast(candidates), "text")
            .groupBy("text").agg(*[F.first(k).alias(k) for k in keys],
                                 F.count(F.lit(1)).alias("lines"))
            .filter(F.col("lines") > F.lit(share) * F.lit(total))
            .select(*keys, "lines", F.lit(total).cast("long").alias("total_lines")))
