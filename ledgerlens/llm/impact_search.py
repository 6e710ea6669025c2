"""Ranked lexical search by dense blocked matrix multiplication.

Every item (query) is scored against every document: the sum, over the item's terms, of
the term's weight times its impact in the document, both integers.  A block of items is
a matrix of weights (items by terms), a tile of documents a matrix of impacts (terms by
documents); their product, by BLAS in float64, holds the scores of the tile.

* Exactness.  Terms are multiplied ``TILE_TERMS`` at a time.  A weight is below
  ``max weight + 1`` and an impact below ``IMPACT``, so a partial sum stays below
  2 ** 53 (checked) and is an exact integer in float64, in whatever order BLAS adds;
  partial products are added as 64-bit integers.
* Compact tiles.  Terms are numbered by falling document frequency, and a tile takes only
  terms that it has, the items that have one of them and the documents that have one.
  The frequent terms make one full product; the many rare ones touch few rows and columns.
* Tie-safe top k.  A task keeps, per item, all candidates at or above the k-th best score
  seen, and cuts them by (score, document id) whenever they pile up; the k best of each
  task are cut again per item and hash bucket of the document, then per item.

Plan: two passes over the documents for each block of items, no shuffle of texts: one
counts documents, terms and document frequencies of the block's terms, the other scores.
Only a block is broadcast, ``BLOCK_CHARS`` characters and ``BLOCK_ITEMS`` items, however many
items there are.  k rows per item and task are shuffled.

Defined results: terms are the maximal matches of ``TERM`` with A-Z in lower case; null or
term-less texts are not counted and never found; items without terms, or without a document
of a positive score, have no rows; rows of one item id are one item with all their terms;
items with a null id are left out; documents with a null id count in the statistics but are
not returned; equal documents are returned once each, in the order of their ids; other columns
are not read; empty tables give an empty result.
"""

from __future__ import annotations

import math
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TOP = 50
BLOCK_ITEMS = 2048
BLOCK_CHARS = 4 << 20
TILE_DOCS = 1024
TILE_CHARS = 8 << 20
TILE_TERMS = 1024
BUCKETS = 64
HELD = 1 << 20             # candidates that a task holds before it cuts them

# The terms, and the constants of the score.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SCALE = 1000               # of the weights
IMPACT = 1_000_000         # impacts are smaller
BASE_LENGTH, LENGTH_SHARE = 100, 50

# bytes that no term has become blanks, A-Z lower case
_PLAIN = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if b >= 0x80 or chr(b).isalnum() else 0x20
               for b in range(256))


def terms(text: str | None) -> list[bytes]:
    """The terms of a text, in order, with repeats."""
    return (text or "").encode("utf-8").translate(_PLAIN).split()


def weight(n: int, df: int) -> int:
    return math.floor(SCALE * math.log((2 * n + 2) / (2 * df + 1)))


class Tile:
    """Term numbers and counts of some documents, for a vocabulary."""

    def __init__(self, texts, number):
        found, lengths = [], []
        for t in texts:
            own = terms(t)
            found.append(np.fromiter(map(number.get, own, repeat(-1)), np.int64, len(own)))
            lengths.append(len(own))
        self.lengths = lengths
        flat = np.concatenate([np.empty(0, np.int64), *found])
        doc = np.repeat(np.arange(len(lengths)), lengths)
        known = flat >= 0
        code, self.count = np.unique(flat[known] * len(lengths) + doc[known], return_counts=True)
        self.term, self.doc = np.divmod(code, max(1, len(lengths)))     # by term, then document


def _tiles(batches):
    """(ids, texts) of about TILE_CHARS characters and TILE_DOCS documents at most."""
    for b in batches:
        ids, held, size, first = b.columns[0], [], 0, 0
        for value in b.columns[1]:
            held.append(value.as_py())
            size += len(held[-1] or "")
            if size >= TILE_CHARS or len(held) == TILE_DOCS:
                yield ids.slice(first, len(held)), held
                first, held, size = first + len(held), [], 0
        if held:
            yield ids.slice(first, len(held)), held


def statistics(docs: DataFrame, vocabulary, doc_id: str, text: str) -> tuple[int, int, dict]:
    """(documents with a term, all their terms, {term: documents that hold it})."""
    names = sorted(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast({t: i for i, t in enumerate(names)})
    whole, total = len(names), len(names) + 1           # numbers of the two other counts

    def run(batches):
        df = np.zeros(len(names) + 2, np.int64)
        for _, texts in _tiles(batches):
            tile = Tile(texts, shared.value)
            df[:whole] += np.bincount(tile.term, minlength=whole)
            df[whole] += np.count_nonzero(tile.lengths)
            df[total] += sum(tile.lengths)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["term", "n"])
    counts = (docs.select(doc_id, text).mapInArrow(run, "term long, n long")
              .groupBy("term").agg(F.sum("n").alias("n")).collect())     # the vocabulary's size
    n = {r["term"]: r["n"] for r in counts}
    return n.get(whole, 0), n.get(total, 0), {t: n.get(i, 0) for i, t in enumerate(names)}


class Block:
    """Items as rows of weights over a vocabulary numbered by falling frequency."""

    def __init__(self, items: dict[int, set[bytes]], documents: int, total: int, df: dict):
        self.documents, self.total = documents, total
        names = sorted((t for t in df if df[t]), key=lambda t: (-df[t], t))
        self.number = {t: i for i, t in enumerate(names)}
        self.weight = np.array([weight(documents, df[t]) for t in names], np.float64)
        if len(names) and TILE_TERMS * (self.weight.max() + 1) * IMPACT >= 2 ** 53:
            raise ValueError("too many terms to a tile for exact sums in float64")
        self.ids = np.array(sorted(items), np.int64)
        pairs = [(self.number[t], i) for i, k in enumerate(self.ids.tolist())
                 for t in items[k] if t in self.number]
        pairs = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.item = pairs[:, 1]                               # by term
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(names) + 1))

    def impacts(self, tile: Tile) -> np.ndarray:
        m = np.array([BASE_LENGTH - LENGTH_SHARE + LENGTH_SHARE * n * self.documents // self.total
                      if n else 0 for n in tile.lengths], np.int64)
        return 10 ** 9 * tile.count // (1000 * tile.count + 20 * m[tile.doc])

    def scores(self, tile: Tile) -> np.ndarray:
        """Items by documents."""
        out = np.zeros((len(self.ids), len(tile.lengths)), np.int64)
        impact = self.impacts(tile)
        here, begin = np.unique(tile.term, return_index=True)
        begin = np.append(begin, len(tile.term))
        for lo in range(0, len(here), TILE_TERMS):
            part = here[lo:lo + TILE_TERMS]
            span = slice(begin[lo], begin[lo + len(part)])
            docs, column = np.unique(tile.doc[span], return_inverse=True)
            right = np.zeros((len(part), len(docs)))
            right[np.searchsorted(part, tile.term[span]), column] = impact[span]
            size = self.first[part + 1] - self.first[part]
            where = np.repeat(self.first[part] - np.cumsum(size) + size, size) + np.arange(size.sum())
            items, row = np.unique(self.item[where], return_inverse=True)
            left = np.zeros((len(items), len(part)))
            term = np.repeat(np.arange(len(part)), size)
            left[row, term] = self.weight[part[term]]
            out[np.ix_(items, docs)] += (left @ right).astype(np.int64)
        return out


def _cut(item, doc, score, k: int):
    """The k best of each item, by falling score, then document id."""
    order = np.lexsort((doc, -score, item))
    item, doc, score = item[order], doc[order], score[order]
    first = np.searchsorted(item, item)                       # where the item's rows begin
    keep = np.arange(len(item)) - first < k
    return item[keep], doc[keep], score[keep]


def best(block: Block, tiles, k: int):
    """(item number, document id, score) arrays of the k best of all tiles."""
    held, size = [], 0
    least = np.ones(len(block.ids), np.int64)                 # a positive score counts
    for ids, texts in tiles:
        tile = Tile(texts, block.number)
        known = np.array(ids.is_valid())
        scores = block.scores(tile)
        i, d = np.nonzero((scores >= least[:, None]) & known)
        held.append((i, np.array(ids.fill_null(0), np.int64)[d], scores[i, d]))
        size += len(i)
        if size > HELD:
            held = [_cut(*map(np.concatenate, zip(*held)), k)]
            size = len(held[0][0])
            full = np.bincount(held[0][0], minlength=len(least)) >= k
            last = np.searchsorted(held[0][0], np.flatnonzero(full), "right") - 1
            least[full] = held[0][2][last]
    return _cut(*map(np.concatenate, zip(*held)), k) if held else None


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """Two cuts, so that no task meets all of an item's candidates."""
    order = [F.desc("score"), F.asc("doc_id")]
    some = Window.partitionBy("item_id", "bucket").orderBy(*order)
    every = Window.partitionBy("item_id").orderBy(*order)
    return (found.withColumn("bucket", F.pmod(F.xxhash64("doc_id"), F.lit(BUCKETS)))
            .withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= k)
            .withColumn("rank", F.row_number().over(every)).filter(F.col("rank") <= k)
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id",
           text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id long, rank int from 1, doc_id long, score long): the k best documents of
    every item."""
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    items = (items.select(F.col(item_id).cast("long").alias("item_id"),
                          F.coalesce(item_text, F.lit("")).alias("text"))
             .filter("item_id IS NOT NULL"))
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")).first()
    blocks = max(1, -(-size["n"] // BLOCK_ITEMS), -(-(size["chars"] or 0) // BLOCK_CHARS))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    out = None
    for b in range(blocks):
        of_block: dict[int, set[bytes]] = {}
        for r in dealt.filter(F.col("block") == b).collect():            # one bounded block
            of_block.setdefault(r["item_id"], set()).update(terms(r["text"]))
        found = _search_block(docs, of_block, k)
        out = found if out is None else out.union(found)
    return _ranked(out, k)


def _search_block(docs: DataFrame, items: dict[int, set[bytes]], k: int) -> DataFrame:
    vocabulary = set().union(*items.values()) if items else set()
    shared = docs.sparkSession.sparkContext.broadcast(
        Block(items, *statistics(docs, vocabulary, "doc_id", "text")))

    def run(batches):
        rows = best(shared.value, _tiles(batches), k)
        if rows is not None:
            item, doc, score = rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(shared.value.ids[item]), pa.array(doc), pa.array(score)],
                names=["item_id", "doc_id", "score"])
    return docs.mapInArrow(run, "item_id long, doc_id long, score long")
