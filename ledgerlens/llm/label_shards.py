"""Sharding by balanced label propagation, in DataFrame functions only.

Documents with equal texts are linked.  All start in the shard of their id's hash;
in each round, a join with the weights of their group's shards tells linked
documents where most of their neighbours are, and they move there as far as the
shard's quota (an even share of all bytes) has room.  Rounds end when nothing moves, and
they do end: a unit only moves to a shard that holds as much of its group or more, so
each move raises the sum of the squared weights of a group's shards.
Documents without links have no preferred shard: they are dealt out afterwards,
large ones first, in proportion to what each shard lacks, which evens out the sizes.

Groups are never expanded into pairs and need not fit a task: the documents of a
group that share a start shard and one of ``SPREAD`` hash places are one unit, which
moves as a whole, so a group of any size is a bounded number of rows.  Running
totals are taken within hash buckets and joined with the buckets' offsets; no shard
or group is sorted in one task.  Only totals of the shards (one row each) reach the
driver.

Defined results: null text counts as empty text (size 1), and empty texts are
linked like all equal texts; rows that share an id are different rows, each with a
slot of its own; a null id is hashed like any other; other columns are not read; an
empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.scratch import stored

SHARDS = 16
SPREAD = 64
FULL = 100                 # a shard that lacks less than this share of its quota is full
BUCKETS = 64               # buckets of a running total, at least
BUCKET_ROWS = 20_000       # rows of a bucket, about

TEXT = ["hash", "crc", "size"]
UNIT = [*TEXT, "start", "place"]


def running(df: DataFrame, by: list[str], value: Column | str, order: list[str], into: str,
            buckets: int) -> DataFrame:
    """df with the exclusive running total of ``value`` within ``by``.

    The order is by hash bucket, then by ``order``; totals of buckets before come
    from a small table of bucket sums."""
    dealt = df.withColumn("__b", F.pmod(F.xxhash64(*order), F.lit(buckets))).withColumn(
        "__v", (F.col(value) if isinstance(value, str) else value).cast("long"))
    before = (Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*by, "__b").agg(F.sum("__v").alias("__s"))
    offsets = sums.select(*by, "__b", F.coalesce(F.sum("__s").over(
        Window.partitionBy(*by).orderBy("__b").rowsBetween(*before)), F.lit(0)).alias("__o"))
    inside = F.coalesce(F.sum("__v").over(
        Window.partitionBy(*by, "__b").orderBy(*order).rowsBetween(*before)), F.lit(0))
    return (dealt.withColumn("__i", inside).join(offsets, [*by, "__b"])
            .withColumn(into, F.col("__i") + F.col("__o")).drop("__b", "__v", "__i", "__o"))


def _loads(units: DataFrame, shards: int) -> list[int]:
    """Bytes in each shard."""
    got = {r["shard"]: r["bytes"] for r in
           units.groupBy("shard").agg(F.sum("bytes").alias("bytes")).collect()}
    return [got.get(s, 0) for s in range(shards)]


def _propagate(units: DataFrame, quota: int, shards: int, buckets: int) -> DataFrame:
    """Linked units with the shards where label propagation leaves them."""
    units = stored(units.withColumn("shard", F.col("start")), "labels")
    while True:
        room = [x if x > quota // FULL else 0
                for x in (quota - y for y in _loads(units, shards))]
        free = F.array(*[F.lit(x).cast("long") for x in room])
        weight = units.groupBy(*TEXT, "shard").agg(F.sum("n").alias("w"))
        # the group's heaviest shard that has room; the lowest of equal ones
        heaviest = (weight.filter(free[F.col("shard")] >= F.col("size"))
                    .groupBy(*TEXT).agg(F.max(F.struct("w", (-F.col("shard")).alias("low"))).alias("best"))
                    .select(*TEXT, F.col("best.w").alias("w_to"),
                            (-F.col("best.low")).alias("to")))
        here = weight.withColumnRenamed("w", "w_here")
        wish = (units.join(heaviest, TEXT).join(here, [*TEXT, "shard"])
                .filter((F.col("to") != F.col("shard"))
                        & ((F.col("w_to") > F.col("w_here"))
                           | ((F.col("w_to") == F.col("w_here")) & (F.col("to") < F.col("shard")))))
                # a unit that does not fit must not stand in the way of others
                .filter(F.col("bytes") <= free[F.col("to")]).select(*UNIT, "to", "bytes"))
        moves = (running(wish, ["to"], "bytes", UNIT, "taken", buckets)
                 .filter(F.col("taken") + F.col("bytes") <= free[F.col("to")])
                 .select(*UNIT, "to"))
        moved = stored(units.join(moves, UNIT, "left"), "moves")
        units = moved.withColumn("shard", F.coalesce("to", "shard")).drop("to")
        if moved.filter("to IS NOT NULL").isEmpty():
            return units


def _deal(units: DataFrame, loads: list[int], quota: int, buckets: int) -> DataFrame:
    """Unlinked units with shards: by size class, large first, in proportion to what the
    shards lack after the classes before."""
    classed = units.withColumn("class", F.floor(F.log2(F.col("size"))).cast("int"))
    placed = stored(running(classed, ["class"], "bytes", UNIT, "at", buckets), "unlinked")
    totals = {r["class"]: r["bytes"] for r in
              placed.groupBy("class").agg(F.sum("bytes").alias("bytes")).collect()}
    loads, chain = list(loads), None
    for c in sorted(totals, reverse=True):
        lack = [max(0, quota - x) for x in loads]
        if not any(lack):
            lack = [1] * len(loads)
        edges, done = [], 0
        for x in lack[:-1]:
            done += x
            edges.append(totals[c] * done // sum(lack))
        middle = F.col("at") + F.expr("size div 2")
        shard = sum(((middle >= e).cast("int") for e in edges), F.lit(0))
        chain = F.when(F.col("class") == c, shard) if chain is None else \
            chain.when(F.col("class") == c, shard)
        added = _loads(placed.filter(F.col("class") == c).withColumn("shard", shard), len(loads))
        loads = [x + y for x, y in zip(loads, added)]
    return placed.withColumn("shard", F.lit(0) if chain is None else chain).drop("class", "at")


def assign(df: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text"
           ) -> DataFrame:
    """(doc_id, size, text_crc32, shard int, slot long) per row."""
    body = F.coalesce(F.col(text), F.lit(""))
    key = F.xxhash64(F.col(doc_id))
    rows = stored(df.select(
        F.col(doc_id).alias("doc_id"), F.xxhash64(body).alias("hash"),
        F.crc32(body.cast("binary")).alias("crc"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.pmod(key, F.lit(shards)).cast("int").alias("start"),
        F.pmod(F.shiftright(key, 20), F.lit(SPREAD)).cast("int").alias("place")), "rows")
    total, count = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    quota = -(-total // shards)
    buckets = max(BUCKETS, count // (shards * BUCKET_ROWS))
    units = rows.groupBy(*UNIT).agg(F.count(F.lit(1)).alias("n"),
                                    F.sum("size").alias("bytes"))
    groups = rows.groupBy(*TEXT).agg(F.count(F.lit(1)).alias("members"))
    units = stored(units.join(groups, TEXT), "units")
    linked = _propagate(units.filter("members > 1").drop("members"), quota, shards, buckets)
    alone = _deal(units.filter("members = 1").drop("members"), _loads(linked, shards), quota,
                  buckets)
    # several units for a large group, one row for each: the join has no hot key
    where = stored(linked.select(*UNIT, "shard").unionByName(alone.select(*UNIT, "shard")),
                   "unit-shards")
    found = stored(rows.join(where, UNIT).select("doc_id", "size", "crc", "shard"), "sharded")
    return running(found, ["shard"], F.lit(1), ["doc_id", "crc", "size"], "slot", buckets).select(
        "doc_id", "size", F.col("crc").alias("text_crc32"), "shard", "slot")
