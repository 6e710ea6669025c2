"""The queries of the training-data operators, with production parameters."""

from __future__ import annotations

import zlib
from functools import wraps

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F

from ledgerlens.llm import (
    ann,
    bpe,
    brown_lm,
    html_main,
    impact_search,
    label_shards,
    line_frequency,
    near_dup,
    oracle,
    ordinal,
    packing,
    url_reputation,
    winnow,
    word_runs,
)
from ledgerlens.session import checkpoint_dir, expose_library
from ledgerlens.sources.tables import read_table

ENCODE_WITH = public_tokenizers.path("word_bpe_49k.json")
PACK_WITH = public_tokenizers.path("byte_bpe_50k.json")


# The rules of the URL filter.
URL_RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/"))


ARROW_ROWS = 1000          # rows that go to a Python worker at once
ARROW_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def registered(query):
    """A query that first makes the session ready: shared folder, library path, and batches
    for Python that are small enough for rows that hold a text each."""
    @wraps(query)
    def run(spark, sf_dir):
        checkpoint_dir(spark)
        expose_library(spark)
        rows = int(spark.conf.get(ARROW_SETTING))
        if not 0 < rows <= ARROW_ROWS:
            spark.conf.set(ARROW_SETTING, str(ARROW_ROWS))
        return query(spark, sf_dir)
    return run


def op1_bpe(spark, sf_dir):
    """Ids and decoded text of every document, as digests."""
    spec = bpe.read_spec(ENCODE_WITH)
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    ids = (bpe.encode(docs, spec)
           .withColumn("ids_sha256", F.sha2("ids", 256)))
    return (bpe.decode(ids, spec, keep=("doc_id", "n_tokens", "ids_sha256"))
            .select("doc_id", "n_tokens", "ids_sha256",
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")))


def op2_ann(spark, sf_dir):
    """The 10 nearest vectors of every hundredth one."""
    return ann.nearest(read_table(spark, sf_dir, "embeddings", ["vec_id", "embedding"]),
                       lambda vec_id: vec_id % 100 == 0)


def pack_documents(spark, docs):
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) per piece."""
    parts = packing.pieces(docs, bpe.read_spec(PACK_WITH), checksum=True)
    return packing.pack(parts.checkpoint())


def op3_pack(spark, sf_dir):
    return pack_documents(spark, read_table(spark, sf_dir, "documents", ["doc_id", "text"]))


def op8_line_frequency(spark, sf_dir):
    """Base counts and verdict of the quality rules for every document."""
    return (line_frequency.judge(read_table(spark, sf_dir, "documents",
                                            ["doc_id", "text", "source"]))
            .drop("n_removed_words"))


def op4_html(spark, sf_dir):
    """Main text of every page."""
    return html_main.extract(read_table(spark, sf_dir, "pages", ["page_id", "url", "html"]))


def op5_url_reputation(spark, sf_dir):
    """Verdict on every page's url; a page's outcome is the label of the document that
    the number in its path names."""
    pages = read_table(spark, sf_dir, "pages", ["page_id", "url"])
    labels = (read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"])
              .filter("quality IS NOT NULL AND toxic IS NOT NULL")
              .select("doc_id", ((F.col("quality") == 1) & (F.col("toxic") == 0)).alias("good")))
    host, path = url_reputation.parts(F.col("url"))
    outcomes = (pages.select(host.alias("host"), F.regexp_extract(path, r"/(\d{1,18})(?!\d)", 1)
                             .try_cast("bigint").alias("doc_id"))
                .join(labels, "doc_id", "left").select("host", "good"))
    return url_reputation.judge(pages, outcomes, URL_RULES)


def op6_minhash(spark, sf_dir):
    """Component of every document by 2-word shingles and Jaccard similarity >= 0.8."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return near_dup.find(docs, size=2).drop("whole")


def graded(labels):
    """(doc_id, grade): 0 toxic, 1 of low quality, 2 good."""
    return (labels.filter("quality IS NOT NULL AND toxic IS NOT NULL")
            .select("doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1)
                    .otherwise(2).alias("grade")))


def op7_ordinal(spark, sf_dir):
    """Score, expected grade, P(good) and verdict for every document."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    ratings = graded(read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    return ordinal.score(docs, ordinal.train(docs, ratings))


def op9_winnow(spark, sf_dir):
    """Every document's text without later repeated runs, as a digest, and what went."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return winnow.dedup(docs).select(
        "row.doc_id", F.sha2(F.col("row.text").cast("binary"), 256).alias("text_sha256"),
        F.length("row.text").cast("long").alias("n_chars"),
        "removed.n_runs", "removed.n_units", "removed.n_words")


def op10_label_shards(spark, sf_dir):
    """Shard and slot of every document: sizes near equal, equal texts together."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    return label_shards.assign(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def looped(doc_id, n):
    """Places of a text's words when a tenth of the documents go round in a loop, by the
    checksum of their id; null ids do not."""
    if doc_id is None:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([np.arange(a), a + np.arange(n - a) % p])


def op11_word_runs(spark, sf_dir):
    """Periodic runs of every document's words: their number, the strongest, digests of all
    of them and of the text without their repeats."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    found = word_runs.detect(docs, arrange=looped)
    best = word_runs.strongest(F.col("runs"))
    lines = F.transform("runs", lambda r: F.concat_ws(",", *[
        r[c].cast("string") for c in ("start", "length", "period")]))
    text = F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n"))))
    return (found.select("doc_id", F.size("runs").cast("long").alias("n_runs"),
                         best.alias("best"), F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
                         F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "best.start", "best.length", "best.period",
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256"))


def op12_brown_lm(spark, sf_dir):
    """Score of every document under the class bigrams and the unigrams of those that are
    not held out."""
    docs = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    scored = brown_lm.score(docs, F.crc32(text.cast("binary")) % 10 != 0)
    return scored.select("row.doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
                         "train_tokens", "base_score", "score")


def op13_impact_search(spark, sf_dir):
    """The 50 highest-scoring documents of every benchmark item."""
    return impact_search.search(read_table(spark, sf_dir, "documents", ["doc_id", "text"]),
                                read_table(spark, sf_dir, "benchmark", ["item_id", "text"]))


LLM_QUERIES = {q.__name__: registered(q) for q in (
    op1_bpe, op2_ann, op3_pack, op4_html, op5_url_reputation, op6_minhash, op7_ordinal,
    op8_line_frequency, op9_winnow, op10_label_shards, op11_word_runs, op12_brown_lm,
    op13_impact_search)}

LLM_ORACLE: dict[str, str] = {
    "op5_url_reputation": oracle.OP5,
    "op8_line_frequency": oracle.OP8,
    "op13_impact_search": oracle.OP13,
}
