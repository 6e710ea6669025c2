"""Quality rules with cross-document line frequency, in DataFrame functions only.

A normalised line (lower case, runs of white space as one space) that stands in
more than ``SHARE_PERCENT`` percent of a host's distinct texts, and in
``MIN_TEXTS`` of them at least, is boilerplate of that host: it is removed, and a
document that loses more than ``DEPLETED_PERCENT`` percent of its words that way is
rejected.  Equal texts count once, so that copies of a document do not make its
lines frequent; they are left to the deduplication.  ``clean`` can be given groups of
near-copies, which then count once too; ``judge`` counts texts, as its SQL does.

Plan: lines are hashed inside the row; only (host, line hash, text hash) triples
are shuffled.  They are first made distinct on all three columns and then counted
per line with a map-side combine, so neither a hot host nor a very frequent line
meets in one task.  The frequent lines of a host are at most ``100 / SHARE_PERCENT``
times its mean number of lines; that table is stored, and Spark picks the join to
the documents from its size.

Defined results: null text has no words and fails the base rules; null hosts form
one host; equal rows are judged alike and all kept or rejected; other columns,
whatever their names, are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.scratch import stored

# Fixed values of the base rules.
SPACE = r"[\x20\x09-\x0D]+"
WORD_CHAR = r"[^\x20\x09-\x0D]"
SYMBOL = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
REPEAT_PERCENT = 30

# Limits of the line rule.
SHARE_PERCENT = 2
MIN_TEXTS = 20
DEPLETED_PERCENT = 80


def _words(text):
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _lines(text):
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _normal(line):
    return F.trim(F.regexp_replace(F.lower(line), SPACE, " "))


def _line_hash(line):
    """Hash of the normalised line; null for a line without a word."""
    return F.when(line.rlike(WORD_CHAR), F.xxhash64(_normal(line)))


def base_counts(df: DataFrame, text: str = "text", keep=("doc_id",)) -> DataFrame:
    """keep columns, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    keep = list(keep)
    t = df.select(*keep, F.coalesce(text, F.lit("")).alias("__text"))
    t = t.select(
        *keep, _words(F.col("__text")).alias("__words"),
        (F.size(F.split("__text", SYMBOL, -1)) - 1).cast("long").alias("n_symbols"),
        F.filter(_lines(F.col("__text")), lambda x: x.rlike(WORD_CHAR)).alias("__lines"))
    t = t.select(
        *keep, "n_symbols", F.size("__words").cast("long").alias("n_words"),
        F.length(F.concat_ws("", "__words")).cast("long").alias("word_chars"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long")
        .alias("n_dup_lines"),
        F.transform("__words", lambda w: F.xxhash64(w)).alias("__hashes"))
    spans = F.transform(
        F.sequence(F.lit(0), F.size("__hashes") - WINDOW),
        lambda i: F.xxhash64(*[F.get("__hashes", i + k) for k in range(WINDOW)]))
    head = [*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    t = t.select(*head, F.when(F.size("__hashes") >= WINDOW, spans).alias("__spans"))
    # most texts repeat no window: only the others are sorted with their places
    t = t.select(*head, F.when(
        F.size(F.array_distinct("__spans")) < F.size("__spans"),
        F.sort_array(F.transform("__spans", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
        .alias("__placed"))
    t = t.select(*head, F.sort_array(F.transform(
        F.filter("__placed", lambda p, j: p["h"].eqNullSafe(F.get("__placed", j - 1)["h"])
                 | p["h"].eqNullSafe(F.get("__placed", j + 1)["h"])),
        lambda p: p["i"])).alias("__starts"))
    zero = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    covered = F.aggregate(
        "__starts", zero,
        lambda a, s: F.struct((a["n"] + s + WINDOW - F.greatest(s, a["end"])).alias("n"),
                              (s + WINDOW).alias("end")),
        lambda a: a["n"].cast("long"))
    t = t.select(*head, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    return t.withColumn("base_failed", failed)


def frequent_lines(df: DataFrame, text: str = "text", host: str = "source",
                   share_percent: int = SHARE_PERCENT, min_texts: int = MIN_TEXTS,
                   groups: DataFrame | None = None, doc_id: str = "doc_id") -> DataFrame:
    """(host, frequent array<long>): hashes of each host's boilerplate lines.

    ``groups`` (doc_id, whole, n_shingles, component_id), as ``near_dup.find`` returns
    it: the texts of a component count once."""
    base = df.select(F.coalesce(host, F.lit("")).alias("host"),
                     F.coalesce(text, F.lit("")).alias("__text"),
                     F.col(doc_id if groups is not None else text).alias("__doc"))
    hashes = F.array_distinct(F.transform(_lines(F.col("__text")), _line_hash))
    base = base.select("host", F.xxhash64("__text", F.length("__text")).alias("whole"),
                       hashes.alias("lines"), "__doc", F.xxhash64("__text").alias("__whole"))
    if groups is not None:
        # of the texts only the lines' hashes move
        near = (groups.filter("n_shingles > 0 AND doc_id IS NOT NULL")
                .select(F.col("doc_id").alias("__doc"), F.col("whole").alias("__whole"),
                        F.xxhash64("component_id").alias("near"))
                .dropDuplicates(["__doc", "__whole"]))
        base = (base.join(near, ["__doc", "__whole"], "left")
                .withColumn("whole", F.coalesce("near", "whole")))
    lines = (base.select("host", "whole", F.explode("lines").alias("line"))
             .filter(F.col("line").isNotNull())
             .groupBy("host", "line", "whole").agg(F.lit(1).alias("one"))
             .groupBy("host", "line").agg(F.count("one").alias("n"))
             .filter(F.col("n") >= min_texts))
    texts = (base.groupBy("host", "whole").agg(F.lit(1).alias("one"))
             .groupBy("host").agg(F.count("one").alias("texts")))
    return (lines.join(texts, "host")
            .filter(100 * F.col("n") > share_percent * F.col("texts"))
            .groupBy("host").agg(F.collect_list("line").alias("frequent")))


def _hits(df: DataFrame, frequent: DataFrame, host: str) -> DataFrame:
    """df with ``frequent``, null where the host has none."""
    return (df.withColumn("__host", F.coalesce(host, F.lit("")))
            .join(frequent.withColumnRenamed("host", "__host")
                  .withColumnRenamed("frequent", "__frequent"), "__host", "left")
            .drop("__host"))


def judge(df: DataFrame, text: str = "text", host: str = "source", doc_id: str = "doc_id",
          depleted_percent: int = DEPLETED_PERCENT) -> DataFrame:
    """doc_id, the base columns, n_removed_words long and kept boolean per row."""
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"),
                     F.col(text).alias("text"))
    frequent = stored(frequent_lines(rows, "text", "host"), "frequent-lines")
    lines = F.transform(_lines(F.col("text")), lambda x: F.struct(
        _line_hash(x).alias("hash"), F.size(_words(x)).alias("words")))
    with_lines = _hits(
        base_counts(rows.withColumn("lines", F.filter(lines, lambda x: x["hash"].isNotNull())),
                    "text", ("doc_id", "host", "lines")), frequent, "host")
    # hash lookup once per document; the sum runs only over its frequent lines
    hit = F.array_intersect(F.col("lines")["hash"], "__frequent")
    out = with_lines.withColumn("__hit", F.when(F.col("__frequent").isNotNull(), hit))
    removed = F.when(F.size("__hit") > 0, F.aggregate(
        "lines", F.lit(0).cast("long"),
        lambda n, x: n + F.when(F.array_contains("__hit", x["hash"]), x["words"]).otherwise(0)))
    out = out.withColumn("n_removed_words", F.coalesce(removed, F.lit(0)).cast("long"))
    kept = ~F.col("base_failed") & (
        100 * F.col("n_removed_words") <= depleted_percent * F.col("n_words"))
    row = F.struct("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                   "n_repeat_words", "base_failed", "n_removed_words", kept.alias("kept"))
    # An explode of one row: a filter on the result would else be pushed below the
    # projections that count, and each of them be evaluated there many times over.
    return out.select(F.explode(F.array(row)).alias("row")).select("row.*")


def clean(df: DataFrame, text: str = "text", host: str = "source",
          depleted_percent: int = DEPLETED_PERCENT, groups: DataFrame | None = None,
          doc_id: str = "doc_id") -> DataFrame:
    """The rows that pass, all columns, their text without the frequent lines; with
    ``groups``, near-copies count as one text (see ``frequent_lines``).

    A kept text that loses a line is joined again by line breaks; all other texts
    are returned as they are."""
    frequent = stored(frequent_lines(df, text, host, groups=groups, doc_id=doc_id),
                      "frequent-lines")
    # the whole row rides along as one struct, so no column name can clash
    rows = _hits(df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__row"),
                           F.col(text).alias("__body"), F.col(host).alias("__source")),
                 frequent, "__source")
    rows = base_counts(rows, "__body", ["__row", "__body", "__frequent"])
    lines = F.transform(_lines(F.col("__body")), lambda x: F.struct(
        x.alias("line"), _line_hash(x).alias("hash")))
    rows = rows.select("__row", "n_words", "base_failed", "__frequent",
                       F.when(F.col("__frequent").isNotNull(), lines).alias("__lines"))
    rows = rows.withColumn("__hit", F.array_intersect(F.col("__lines")["hash"], "__frequent"))
    rows = rows.withColumn("__left", F.when(F.size("__hit") > 0, F.concat_ws("\n", F.transform(
        F.filter("__lines", lambda x: x["hash"].isNull()
                 | ~F.array_contains("__hit", x["hash"])), lambda x: x["line"]))))
    lost = F.col("n_words") - F.size(_words(F.col("__left")))
    kept = ~F.col("base_failed") & (
        F.col("__left").isNull() | (100 * lost <= depleted_percent * F.col("n_words")))
    new = F.col("__row").withField(text, F.coalesce("__left", F.col("__row")[text]))
    # An explode of nothing or one row, not a filter: see judge
    return rows.select(F.explode(F.when(kept, F.array(new))).alias("__row")).select("__row.*")
