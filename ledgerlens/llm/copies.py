"""Classes of near-copies for the quality rules, in DataFrame functions only.

A text's sketch is the ``SKETCH`` smallest hashes of its word shingles.  Texts that share one of
their ``KEYS`` smallest are candidates; each is compared with the first of those that share it,
never with all.  Of the smallest hashes of both together, the share that both have estimates
the similarity; from ``PERCENT`` percent on two texts are linked, and links are joined into
classes.  ``near_dup`` confirms on full sets and misses nothing; here an estimate will do, as a
class only counts once in a line's frequency.

Only sketches move: once to be stored, and again for texts that share a key.

Defined results: a null or blank text has no shingles and is a class of its own, as is a null
id; rows equal in id and text are one; a text with fewer words than a shingle has them as its one
shingle; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.graph import components
from ledgerlens.llm.line_frequency import _words
from ledgerlens.llm.scratch import stored

SKETCH = 32
KEYS = 4
PERCENT = 70               # of the sketches; a pair at 80 percent falls below in 8 of 100 cases,
                           # and pairs from about 65 percent on can be linked


def sketches(df: DataFrame, size: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, whole, sketch array<long>): smallest shingle hashes in order, null without words."""
    body = F.lower(F.coalesce(F.col(text), F.lit("")))
    t = df.select(F.col(doc_id).alias("doc_id"),
                  F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("whole"),
                  F.transform(_words(body), lambda w: F.xxhash64(w)).alias("words"))
    spans = F.transform(F.sequence(F.lit(0), F.size("words") - size),
                        lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(size)]))
    t = t.select("doc_id", "whole", F.when(F.size("words") >= size, spans).when(
        F.size("words") > 0, F.array(F.xxhash64("words"))).alias("spans"))
    # repeated shingles stand side by side after sorting
    few = F.slice(F.sort_array("spans"), 1, 2 * SKETCH)
    return t.select("doc_id", "whole", F.slice(F.array_distinct(few), 1, SKETCH).alias("sketch"))


def classes(df: DataFrame, size: int = 5, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, whole, n_shingles, component_id): rows of one component are near-copies; the
    columns that ``line_frequency`` takes from ``near_dup.find``."""
    rows = stored(sketches(df, size, doc_id, text)
                  .withColumn("node", F.xxhash64("doc_id", "whole")), "copy-sketches")
    known = rows.filter("sketch IS NOT NULL AND doc_id IS NOT NULL")
    keys = known.select("node", F.explode(F.slice("sketch", 1, KEYS)).alias("key"))
    first = stored(keys.groupBy("key").agg(F.min("node").alias("first"),
                                           F.max("node").alias("last"))
                   .filter("first <> last").select("key", "first"), "copy-keys")
    pairs = stored(keys.join(first, "key").filter("node <> first")
                   .select("node", "first").distinct(), "copy-pairs")
    side = known.groupBy("node").agg(F.first("sketch").alias("sketch"))
    both = (pairs.join(side, "node")
            .join(side.select(F.col("node").alias("first"), F.col("sketch").alias("other")), "first"))
    shared = F.array_intersect("sketch", "other")
    union = F.slice(F.sort_array(F.array_union("sketch", "other")), 1, SKETCH)
    linked = 100 * F.size(F.array_intersect(union, shared)) >= PERCENT * F.size(union)
    links = stored(both.filter(linked).select(F.col("node").alias("a"), F.col("first").alias("b")),
                   "copy-links")
    labels = components(links)
    return rows.join(labels, "node", "left").select(
        "doc_id", "whole", F.when(F.col("sketch").isNull(), 0).otherwise(F.size("sketch"))
        .cast("long").alias("n_shingles"), F.coalesce("label", "node").alias("component_id"))
