"""From raw documents to packed training sequences, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is written as
Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``.

Defined results:

* quality_rules: null, blank and short texts fail the base rules and go; a null source is a
  host of its own; equal rows are judged alike.
* quality_classifier: unrated documents are judged by the model, rated ones too; with fewer
  than two grades among the ratings there is no model, and all documents stay.
* line_dedup: texts without a repeated run come back byte for byte; null texts and rows with a
  null id as they are; a text that stands elsewhere in full is left empty.
* minhash_near_dedup: rows equal in id and text become one; null and blank texts and null ids
  are linked with nothing and stay.
* best_fit_packing: a null text is an empty one, which has the end id alone.

All but the last stage return every column, whatever its name, and an empty table gives an
empty result in each.  Three decisions belong to the pipeline:

* A line's frequency counts near-copies of a document once: else a large group's own
  lines would be frequent, and the group be rejected with its original.  For that the first
  stage estimates classes of near-copies by DataFrame functions; it removes none of them.
* Line deduplication leaves a document as it is if it shares ``SPARE_PERCENT``
  percent of the union of shingles with one earlier document that stays whole: the
  next stage links the two and keeps one, rather than shreds of the others.  Excerpts,
  mixtures and texts less similar than that are cut.
* Near-duplicates share 0.8 of their five-word shingles.

No stage sequence of this kind has an SQL form (hashed regression, union of matched
runs, iterative linking), so there is no ORACLE_SQL; the stages are tested against
brute force.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.llm import copies, line_frequency, near_dup, ordinal, winnow
from ledgerlens.llm.catalog import graded, pack_documents, registered
from ledgerlens.llm.scratch import stored
from ledgerlens.sources.tables import read_table

SPARE_PERCENT = 80
SHINGLE = 5


def _measured(docs):
    """n_chars follows the text, where the table has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) \
        if "n_chars" in docs.columns else docs


def quality_rules(spark, docs, sf_dir):
    groups = stored(copies.classes(docs.select("doc_id", "text"), SHINGLE), "near-copies")
    return _measured(line_frequency.clean(docs, groups=groups))


def quality_classifier(spark, docs, sf_dir):
    ratings = graded(read_table(spark, sf_dir, "labels", ["doc_id", "quality", "toxic"]))
    row = F.struct(*[F.col(c) for c in docs.columns])
    scored = ordinal.score(docs.select(row.alias("row"), "text"),
                           ordinal.train(docs, ratings), keep=("row",))
    return scored.filter("kept").select("row.*")


def line_dedup(spark, docs, sf_dir):
    return _measured(winnow.dedup(docs, spare_percent=SPARE_PERCENT, size=SHINGLE)
                     .select("row.*"))


def minhash_near_dedup(spark, docs, sf_dir):
    return near_dup.survivors(docs, SHINGLE)


def best_fit_packing(spark, docs, sf_dir):
    return pack_documents(spark, docs)


def _ready(stage):
    """The stage, with the session's shared folder and library path set up first."""
    def run(spark, docs, sf_dir):
        return registered(lambda s, d: stage(s, docs, d))(spark, sf_dir)
    return run


STAGES = [(f.__name__, _ready(f)) for f in (
    quality_rules, quality_classifier, line_dedup, minhash_near_dedup, best_fit_packing)]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, one after the other, over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
